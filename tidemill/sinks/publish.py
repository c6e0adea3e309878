"""Publishing of a table change: all of it becomes visible, or none, also when the load dies in between.

The rows of a change are written to a new folder beside the table.  A journal file says what the change is about
to do before it does it:

* ``writing``: the folder is being filled; nothing has changed yet.
* ``switching``: the folder is complete; these partitions move from these old places to these new ones.
* ``returning``: a switch failed; every partition goes back to its old place.
* ``cleaning``: the change is visible; these folders and empty partitions are left to delete.

An error while switching turns every switch back and leaves the old rows.  If the process dies (or cannot
turn back), the next load of the table finds the journal and ends the change: a folder that was being written goes,
a switch or a return is carried on to its end, a cleanup is done again.  Every step can be repeated.  A table has one writer at a time.
"""

from __future__ import annotations

import json
import logging
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import SparkSession

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder of a NULL partition
_SUFFIX = re.compile(r"__v[0-9a-f]{10}$")
#: Catalog calls made side by side.
CATALOG_THREADS = 8
_log = logging.getLogger(__name__)

Folder = tuple[str, ...]
#: Folders of the changes that this process is making: no other load's leftovers.
_live: set[str] = set()


def quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def location(spark: SparkSession, table: str, spec: str = "") -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)} {spec}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")  # of a partition its own comes first, then that of the table


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    where, files = file_system(spark, path)
    files.delete(where, True)


def children(spark: SparkSession, path: str) -> list[str]:
    where, files = file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []


def folders(spark: SparkSession, path: str, depth: int) -> list[Folder]:
    """Names of the partition folders below a path, one tuple per partition."""
    names = [n for n in children(spark, path) if "=" in n]
    if depth == 1:
        return [(n,) for n in names]
    return [(n, *rest) for n in names for rest in folders(spark, f"{path}/{n}", depth - 1)]


def spec_of(folder: Sequence[str]) -> str:
    """PARTITION clause of a folder like day=2024-01-31."""
    parts = []
    for name, value in (f.split("=", 1) for f in folder):
        text = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"`{unquote(name)}` = " + ("NULL" if value == NULL_FOLDER else f"'{text}'"))
    return "PARTITION (" + ", ".join(parts) + ")"


def show_partitions(spark: SparkSession, table: str) -> list[Folder]:
    return [tuple(r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect()]


def value_of(folder: Folder, column: str) -> str:
    """The text of one partition column in a folder of a table with any number of them."""
    return dict(f.split("=", 1) for f in folder)[column]


def set_location(spark: SparkSession, table: str, spec: str, path: str) -> None:
    spark.sql(f"ALTER TABLE {quoted(table)} {spec} SET LOCATION '{path}'")


def add_partitions(spark: SparkSession, table: str, places: Sequence[tuple[Folder, str]]) -> None:
    clauses = " ".join(f"{spec_of(f)} LOCATION '{p}'" for f, p in places)
    spark.sql(f"ALTER TABLE {quoted(table)} ADD IF NOT EXISTS {clauses}")


def drop_partitions(spark: SparkSession, table: str, found: Sequence[Folder]) -> None:
    spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS {', '.join(map(spec_of, found))}")


def _side_by_side(work: Callable, items: Sequence) -> list:
    if len(items) < 2:
        return [work(i) for i in items]
    with ThreadPoolExecutor(CATALOG_THREADS) as pool:
        return list(pool.map(work, items))


def _batches(items: Sequence, size: int = 500) -> Iterable[Sequence]:
    return (items[i:i + size] for i in range(0, len(items), size))


@dataclass
class Change:
    """One change of a table, as the journal holds it."""

    table: str
    base: str
    path: str
    state: str = "writing"
    #: (partition folder or () for a whole table, old place, new place)
    switches: list[tuple[Folder, str, str]] = field(default_factory=list)
    #: (partition folder, new place) of partitions that the table did not have
    added: list[tuple[Folder, str]] = field(default_factory=list)
    #: partitions that come out empty; they are switched to an empty folder before they are dropped
    emptied: list[Folder] = field(default_factory=list)

    @classmethod
    def start(cls, spark: SparkSession, table: str) -> Change:
        """Ends what an earlier load left, then opens a change with a new folder."""
        recover(spark, table)
        base = _base(spark, table)
        change = cls(table, base, f"{base}__v{uuid.uuid4().hex[:10]}")
        _live.add(change.path)
        change._note(spark)
        return change

    def close(self, spark: SparkSession) -> None:
        """The process is through with the change; one that was never published is undone."""
        if self.state == "writing":
            self.abandon(spark)
        _live.discard(self.path)

    @property
    def _file(self) -> str:
        return f"{self.base}__journal/{self.path.rsplit('__v', 1)[1]}.json"

    def _note(self, spark: SparkSession) -> None:
        """Writes the journal file anew; it appears as a whole."""
        where, files = file_system(spark, self._file)
        draft = where.suffix(".draft")
        stream = files.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(asdict(self)).encode()))
        finally:
            stream.close()
        if files.exists(where):
            files.delete(where, False)
        if not files.rename(draft, where):
            raise OSError(f"journal file {self._file} cannot be written")

    def _forget(self, spark: SparkSession) -> None:
        where, files = file_system(spark, self._file)
        for file in (where, where.suffix(".draft")):
            files.delete(file, False)
        if not files.listStatus(where.getParent()):
            files.delete(where.getParent(), True)

    def abandon(self, spark: SparkSession) -> None:
        """Nothing was switched: the new folder goes."""
        try:
            delete_folder(spark, self.path)
            self._forget(spark)
        except Exception as fault:
            _log.warning("%s: folder %s is left for the next load (%s)", self.table, self.path, fault)

    def publish(self, spark: SparkSession, touched: Callable[[Folder], bool] | None = None) -> None:
        """The written folder becomes the table's content.

        touched: says which of the table's partitions the change replaces; such a partition that the folder lacks comes out empty, others
        stay.  Without it all partitions change.
        """
        columns = partition_columns(spark, self.table)
        if not columns:
            self.switches = [((), location(spark, self.table), self.path)]
        else:
            found, before = folders(spark, self.path, len(columns)), set(show_partitions(spark, self.table))
            self.emptied = [f for f in before.difference(found) if touched is None or touched(f)]
            moved = [f for f in found if f in before] + self.emptied
            old = _side_by_side(lambda f: location(spark, self.table, spec_of(f)), moved)
            self.switches = [(f, was, f"{self.path}/{'/'.join(f)}") for f, was in zip(moved, old)]
            self.added = [(f, f"{self.path}/{'/'.join(f)}") for f in found if f not in before]
            for folder in self.emptied:
                where, files = file_system(spark, f"{self.path}/{'/'.join(folder)}")
                files.mkdirs(where)
        self.state = "switching"
        self._note(spark)
        try:
            self._switch(spark)
        except BaseException:
            self._turn_back(spark)
            raise
        self._clean(spark)

    def _switch(self, spark: SparkSession) -> None:
        _side_by_side(lambda s: set_location(spark, self.table, spec_of(s[0]) if s[0] else "", s[2]), self.switches)
        for some in _batches(self.added):
            add_partitions(spark, self.table, some)
        spark.catalog.refreshTable(self.table)

    def _turn_back(self, spark: SparkSession) -> None:
        """Every partition to its old place, whether or not it was switched.  If that fails too, the next load does it."""
        try:
            self.state = "returning"
            self._note(spark)
            self._return(spark)
        except BaseException as fault:
            _log.warning("%s: the next load ends a change that failed halfway (%s)", self.table, fault)

    def _return(self, spark: SparkSession) -> None:
        _side_by_side(lambda s: set_location(spark, self.table, spec_of(s[0]) if s[0] else "", s[1]), self.switches)
        for some in _batches([f for f, _ in self.added]):
            drop_partitions(spark, self.table, some)
        spark.catalog.refreshTable(self.table)
        self.abandon(spark)

    def _clean(self, spark: SparkSession) -> None:
        """Old places and empty partitions go.  The rows are published: what cannot be deleted is left for the next load."""
        try:
            if self.state != "cleaning":
                self.state = "cleaning"
                self._note(spark)
            for some in _batches(self.emptied):
                drop_partitions(spark, self.table, some)
            gone = [old for _, old, new in self.switches if old != new] + [new for f, _, new in self.switches if f in set(self.emptied)]
            _side_by_side(lambda place: delete_folder(spark, place), gone)
            for parent in {p for p in map(_version_folder, gone) if p and p not in gone}:
                if not folders(spark, parent, len(self.switches[0][0])):
                    delete_folder(spark, parent)
            if not self.added and all(f in self.emptied for f, _, _ in self.switches):
                delete_folder(spark, self.path)
            self._forget(spark)
        except Exception as fault:
            _log.warning("%s: old files are left for the next load (%s)", self.table, fault)

    def finish(self, spark: SparkSession) -> None:
        """Ends a change that another process began."""
        if self.state == "writing":
            self.abandon(spark)
        elif self.state == "returning":
            self._return(spark)
        else:
            if self.state == "switching":
                self._switch(spark)
            self._clean(spark)


def _base(spark: SparkSession, table: str) -> str:
    return _SUFFIX.sub("", location(spark, table))


def _version_folder(place: str) -> str | None:
    """The folder of the change that a partition's place lies in."""
    parts = place.split("/")
    for n in range(len(parts), 0, -1):
        if _SUFFIX.search(parts[n - 1]):
            return "/".join(parts[:n])
    return None


def _open_changes(spark: SparkSession, base: str) -> list[Change]:
    """The changes in a table's journal; a draft counts where its file is missing, as it is whole then."""
    names = children(spark, f"{base}__journal")
    texts = []
    for name in names:
        if name.endswith(".json") or (name.endswith(".draft") and name.removesuffix(".draft") not in names):
            texts.append("".join(r[0] for r in spark.read.text(f"{base}__journal/{name}", wholetext=True).collect()))
    found = []
    for text in texts:
        content = json.loads(text)
        found.append(Change(**content | {"switches": [(tuple(f), a, b) for f, a, b in content["switches"]],
                                         "added": [(tuple(f), p) for f, p in content["added"]],
                                         "emptied": [tuple(f) for f in content["emptied"]]}))
    return [c for c in found if c.path not in _live]


def recover(spark: SparkSession, table: str) -> int:
    """Ends the changes that earlier loads of the table left open; how many."""
    changes = _open_changes(spark, _base(spark, table))
    for change in changes:
        change.finish(spark)
        spark.catalog.refreshTable(table)
    return len(changes)


def drop_target(spark: SparkSession, table: str) -> None:
    """Drops a table with all folders that its loads have made."""
    base = _base(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")
    parent, name = base.rsplit("/", 1)
    for child in children(spark, parent):
        if child in (name, f"{name}__journal") or (child.startswith(f"{name}__v") and _SUFFIX.search(child)):
            delete_folder(spark, f"{parent}/{child}")
