"""Fault injection: whatever step of a load fails, and however, the table holds all old rows or all new ones."""

import os
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import types as T

from tidemill.sinks import publish, tables as sinks

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("r", T.StringType()),
                       T.StructField("stat_date", T.DateType())])
D = [date(2025, 1, i) for i in (1, 2, 3, 4)]
OLD = [(1, "a", "x", 0), (2, "b", "x", 1), (3, "c", "y", 1), (4, "d", "y", 2), (5, "e", None, None)]
LAYOUTS = {"plain": [], "days": ["stat_date"], "days and regions": ["stat_date", "r"]}


class Died(BaseException):
    """The process ends here: nothing that follows in it runs."""


def data(spark, records):
    return spark.createDataFrame([(i, v, r, None if d is None else D[d]) for i, v, r, d in records], SCHEMA)


@pytest.fixture(params=LAYOUTS)
def table(request, spark, database):
    return filled(spark, database, request.param)


@pytest.fixture
def deep_table(spark, database):
    return filled(spark, database, "days and regions")


def filled(spark, database, layout):
    name = f"{database}.t"
    sinks.create_target(spark, name, SCHEMA, partition_by=LAYOUTS[layout])
    sinks.overwrite(data(spark, OLD), name)
    return name


def content(spark, table):
    spark.catalog.refreshTable(table)
    return rows(spark.table(table).select("id", "v", "r", "stat_date"))


def expected(records):
    return sorted(((i, v, r, None if d is None else D[d]) for i, v, r, d in records), key=lambda t: tuple((x is None, str(x)) for x in t))


NEW = [(1, "A", "x", 0), (7, "g", "z", 1), (8, "h", None, 3)]
LOADS = {
    "overwrite": (lambda spark, t: sinks.overwrite(data(spark, NEW), t), NEW),
    "replace_days": (lambda spark, t: sinks.replace_days(data(spark, [(9, "i", "x", 1), (10, "j", "w", 3)]), t, [D[1], D[2], D[3], None]),
                     [OLD[0], (9, "i", "x", 1), (10, "j", "w", 3)]),
    "replace_day": (lambda spark, t: sinks.replace_day(data(spark, [(9, "i", "x", 1)]), t, D[1]), [OLD[0], OLD[3], OLD[4], (9, "i", "x", 1)]),
    "clear_day": (lambda spark, t: sinks.replace_day(data(spark, []), t, D[1]), [OLD[0], OLD[3], OLD[4]]),
    "upsert": (lambda spark, t: sinks.upsert(data(spark, [(1, "A", "x", 0), (6, "f", "x", 3)]), t, ["id", "stat_date", "r"]),
               [(1, "A", "x", 0), (6, "f", "x", 3), *OLD[1:]]),
}
CALLS = ("set_location", "add_partitions", "drop_partitions", "delete_folder")


def partitioned_only(load, table, spark):
    if load.startswith(("replace", "clear")) and not publish.partition_columns(spark, table):
        pytest.skip("days are partitions")


def folders_beside(spark, table):
    base = publish._base(spark, table)
    return sorted(os.listdir(os.path.dirname(base).removeprefix("file:")))


@pytest.mark.parametrize("load", LOADS)
def test_load_leaves_its_rows_and_nothing_else(spark, table, load):
    partitioned_only(load, table, spark)
    for _ in range(2):
        LOADS[load][0](spark, table)
        assert content(spark, table) == expected(LOADS[load][1])
    parts = publish.partition_columns(spark, table)
    used = {publish.location(spark, table, publish.spec_of(f)) for f in publish.show_partitions(spark, table)} if parts else {publish.location(spark, table)}
    base = publish._base(spark, table)
    kept = [n for n in folders_beside(spark, table) if not any(f"/{n}/" in u + "/" for u in used)]
    assert kept in ([], [base.rsplit("/", 1)[1]])  # the table's own folder stays while partitions lie elsewhere
    sinks.drop_target(spark, table)
    assert not os.path.exists(base.removeprefix("file:")) and not any("__" in n for n in os.listdir(os.path.dirname(base).removeprefix("file:")))


def fail_at(monkeypatch, call, which, error, forever=False):
    """The `which`-th use of a catalog or file call raises, later ones too if `forever`; returns how often it was used."""
    used, whole = [0], getattr(publish, call)

    def broken(*args):
        used[0] += 1
        if used[0] == which or (forever and used[0] > which):
            raise error
        return whole(*args)
    monkeypatch.setattr(publish, call, broken)
    return used


@pytest.mark.parametrize("call", CALLS)
@pytest.mark.parametrize("load", ["overwrite", "replace_days"])
def test_an_error_at_any_step(spark, deep_table, load, call, monkeypatch):
    """The load fails and the old rows stay, or what failed was the cleanup and the new ones are there; the next load works."""
    table = deep_table
    monkeypatch.setattr(publish, "CATALOG_THREADS", 1)
    for which in (1, 3):
        with monkeypatch.context() as patch:
            used = fail_at(patch, call, which, OSError("injected"))
            try:
                LOADS[load][0](spark, table)
                want = LOADS[load][1]
            except OSError:
                want = OLD
            assert content(spark, table) == expected(want)
        sinks.overwrite(data(spark, OLD), table)
        assert content(spark, table) == expected(OLD)
        assert not any(n.endswith("__journal") for n in folders_beside(spark, table))
        if used[0] < which:
            break


@pytest.mark.parametrize("call", CALLS)
@pytest.mark.parametrize("load", ["replace_days"])
def test_a_process_that_dies_at_any_step(spark, deep_table, load, call, monkeypatch):
    """From the step on nothing works, not even turning back; the next process ends the change, forward or back."""
    table = deep_table
    monkeypatch.setattr(publish, "CATALOG_THREADS", 1)
    for which in (1, 3):
        with monkeypatch.context() as patch:
            used = fail_at(patch, call, which, Died(), forever=True)
            for other in CALLS:
                if other != call:
                    whole = getattr(publish, other)
                    patch.setattr(publish, other, lambda *a, whole=whole: (_ for _ in ()).throw(Died()) if used[0] >= which else whole(*a))
            try:
                LOADS[load][0](spark, table)
            except Died:
                pass
        publish._live.clear()
        sinks.recover(spark, table)
        assert content(spark, table) in (expected(OLD), expected(LOADS[load][1]))
        assert not any(n.endswith("__journal") for n in folders_beside(spark, table))
        sinks.overwrite(data(spark, OLD), table)
        assert content(spark, table) == expected(OLD)
        if used[0] < which:
            break


def test_a_switch_is_carried_on_by_the_next_load(spark, table, monkeypatch):
    """Dead after the journal said what to switch: the rows are old, and new once the next load has opened the table."""
    with monkeypatch.context() as patch:
        patch.setattr(publish.Change, "_switch", lambda self, spark: (_ for _ in ()).throw(Died()))
        patch.setattr(publish.Change, "_turn_back", lambda self, spark: None)
        with pytest.raises(Died):
            sinks.overwrite(data(spark, NEW), table)
    assert content(spark, table) == expected(OLD)
    assert sinks.append(data(spark, [(11, "k", "x", 0)]), table).inserted == 1
    assert content(spark, table) == expected([*NEW, (11, "k", "x", 0)])


def test_a_draft_counts_where_its_file_is_missing(spark, table):
    change = publish.Change.start(spark, table)
    publish.Change.close(change, spark)
    change = publish.Change.start(spark, table)
    file = change._file.removeprefix("file:")
    os.rename(file, file + ".draft")
    publish._live.clear()
    assert sinks.recover(spark, table) == 1 and sinks.recover(spark, table) == 0


def test_day_with_two_partition_columns(spark, database):
    name = f"{database}.two"
    sinks.create_target(spark, name, SCHEMA, partition_by=["stat_date", "r"])
    sinks.overwrite(data(spark, OLD), name)
    assert sinks.replace_day(data(spark, [(9, "i", "x", 1)]), name, D[1]) == sinks.LoadReport(inserted=1, deleted=2)
    assert content(spark, name) == expected([OLD[0], OLD[3], OLD[4], (9, "i", "x", 1)])
    assert sinks.replace_days(data(spark, []), name, [D[1], None]) == sinks.LoadReport(inserted=0, deleted=2)
    assert content(spark, name) == expected([OLD[0], OLD[3]])
    with pytest.raises(ValueError):
        sinks.replace_days(data(spark, [(9, "i", "x", 1)]), name, [D[0]])
    assert content(spark, name) == expected([OLD[0], OLD[3]])


def test_many_partitions_take_few_statements(spark, database, monkeypatch):
    name, said = f"{database}.many", []
    sinks.create_target(spark, name, SCHEMA, partition_by=["r"])
    whole = spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (said.append(text), whole(text, *a, **k))[1])
    sinks.overwrite(data(spark, [(n, "v", f"r{n}", 0) for n in range(60)]), name)
    assert len([s for s in said if s.startswith("ALTER")]) == 1 and len(publish.show_partitions(spark, name)) == 60


def test_bucketed_target_keeps_its_buckets(spark, database):
    name = f"{database}.bucketed"
    sinks.create_target(spark, name, SCHEMA, bucket_by=["id"], buckets=4, partition_by=["stat_date"])
    sinks.overwrite(data(spark, OLD), name)
    sinks.replace_day(data(spark, [(9, "i", "x", 1), (10, "i", "x", 1)]), name, D[1])
    assert content(spark, name) == expected([OLD[0], OLD[3], OLD[4], (9, "i", "x", 1), (10, "i", "x", 1)])
    assert "Exchange" not in spark.table(name).groupBy("id").count()._jdf.queryExecution().executedPlan().toString()


def test_key_buckets(spark, database):
    """An upsert rewrites the buckets of its keys and no other file."""
    name, schema = f"{database}.keyed", T.StructType(SCHEMA.fields[:3])
    sinks.create_target(spark, name, schema, upsert_keys=["id"], key_buckets=16)
    first = [(i, f"v{i}", None if i % 3 else "x") for i in range(300)]
    sinks.append(spark.createDataFrame(first, schema), name)

    def files():
        return {(r[0], r[1]) for r in spark.table(name).select("key_bucket", "_metadata.file_path").distinct().collect()}
    before = files()
    changed = spark.createDataFrame([(5, "new", None), (6, "new", "y"), (1000, "more", None)], "id int, v string, r string")
    for inserted in (1, 0):
        assert sinks.upsert(changed, name, ["id"]) == sinks.LoadReport(inserted=inserted, updated=3 - inserted)
        want = {i: (v, r) for i, v, r in first} | {5: ("new", None), 6: ("new", "y"), 1000: ("more", None)}
        assert {r.id: (r.v, r.r) for r in spark.table(name).collect()} == want and spark.table(name).count() == 301
    touched = {r[0] for r in spark.table(name).filter("id in (5, 6, 1000)").select("key_bucket").collect()}
    assert {b for b, _ in before - files()} <= touched and len(touched) <= 3
    assert {f for f in before if f[0] not in touched} == {f for f in files() if f[0] not in touched}
    plan = spark.table(name).filter(sinks._in_folders([("key_bucket=3",)]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    with pytest.raises(sinks.SourceKeyError):
        sinks.upsert(spark.createDataFrame([(None, "a", "b")], schema), name, ["id"])
