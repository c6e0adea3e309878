"""Flatten JSON documents held in a text column."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import cut_lineage

def document_schema(df: DataFrame, column: str) -> T.StructType:
    """Merged schema of all documents: one distributed aggregate, one row to the driver."""
    text = df.agg(F.schema_of_variant_agg(F.parse_json(column)).alias("s")).first()["s"]
    # the type names stand outside quoted keys
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text)
    parsed = T._parse_datatype_string(ddl)
    if not isinstance(parsed, T.StructType):
        raise ValueError(f"the documents are no JSON objects but {text}")
    return parsed


def leaves(schema: T.StructType, above: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    """(names from the root, type) of every leaf; an array is a leaf and is not dropped."""
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            yield from leaves(f.dataType, (*above, f.name))
        else:
            yield (*above, f.name), f.dataType


# The names of variant types, as `schema_of_variant` gives them.
_VARIANT_NAMES = {"BIGINT": "int", "STRING": "str", "DOUBLE": "float", "BOOLEAN": "bool", "VOID": "NoneType"}
#: Levels that are opened in the first pass; doubled as long as there are deeper ones.
LEVELS = 4


def _leaf_rows(df: DataFrame, column: str, sep: str, levels: int) -> DataFrame:
    """(path, name, kind) of every value that is no object; objects deeper than `levels` stay, as kind OBJECT."""
    spark = df.sparkSession
    rows = df.select(F.parse_json(column).alias("v")).filter(F.col("v").isNotNull()).select(
        "v", F.schema_of_variant("v").alias("kind"), F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("name"))
    for _ in range(levels):
        rows = rows.withColumn("object", F.when(F.col("kind").startswith("OBJECT"), F.col("v")))
        opened = rows.lateralJoin(spark.tvf.variant_explode_outer(F.col("object").outer()).toDF("pos", "key", "value"))
        inside = F.col("key").isNotNull()
        opened = opened.filter(inside | F.col("object").isNull())  # an empty object has no leaf
        rows = opened.select(F.when(inside, F.col("value")).otherwise(F.col("v")).alias("v"),
                             F.when(inside, F.schema_of_variant("value")).otherwise(F.col("kind")).alias("kind"),
                             F.when(inside, F.concat_ws(sep, "path", "key")).otherwise(F.col("path")).alias("path"),
                             F.when(inside, F.col("key")).otherwise(F.col("name")).alias("name"))
    kind = F.regexp_extract("kind", "^[A-Z]+", 0)
    return rows.select("path", "name", kind.alias("kind"))


def json_paths(df: DataFrame, column: str, sep: str = ".") -> DataFrame:
    """(path, name, type, documents): every leaf path and in how many documents it has a value.

    Documents are opened level by level in the cluster and counted there, so keys that are data make rows, not columns.
    An array is a leaf. Whole and broken numbers under one path are float, other mixtures variant; a path that is
    never more than null is NoneType. The result is kept in the shared folder, which tells whether a deeper pass is needed.
    """
    levels = LEVELS
    while True:
        leaves_ = _leaf_rows(df, column, sep, levels)
        names = F.create_map(*[F.lit(x) for pair in _VARIANT_NAMES.items() for x in pair])
        named = F.when(F.col("kind") == "ARRAY", "list").when(F.col("kind").isin("DECIMAL", "FLOAT"), "float").otherwise(
            F.coalesce(F.try_element_at(names, F.col("kind")), F.lower("kind")))
        counted = leaves_.select("path", "name", named.alias("type"), (F.col("kind") != "VOID").alias("value")).groupBy("path", "name").agg(
            F.array_sort(F.array_remove(F.collect_set("type"), "NoneType")).alias("types"), F.count_if("value").alias("documents"))
        counted = cut_lineage(counted)
        if not counted.filter(F.array_contains("types", "object")).limit(1).count():
            break
        levels *= 2
    if counted.filter(F.col("path").isNull()).limit(1).count():
        raise ValueError("the documents are no JSON objects")
    kinds = F.size("types")
    merged = (F.when(kinds == 0, "NoneType").when(kinds == 1, F.try_element_at("types", F.lit(1)))
              .when(F.col("types") == F.array(F.lit("float"), F.lit("int")), "float").otherwise("variant"))
    return counted.select("path", "name", merged.alias("type"), "documents")


def _at(doc: Column, path: tuple[str, ...]) -> Column:
    for name in path:
        doc = doc.getField(name)
    return doc


def json_columns(df: DataFrame, column: str, schema: T.StructType | None = None, sep: str = ".") -> DataFrame:
    """Replace the JSON column by one column per leaf, named by its path."""
    schema = schema or document_schema(df, column)
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.withColumn("__doc", F.from_json(column, schema)).select(
        *others, *[_at(F.col("__doc"), path).alias(sep.join(path)) for path, _ in leaves(schema)])


def array_as_text(array: Column, sep: str = ", ") -> Column:
    return F.array_join(array.cast("array<string>"), sep)


def array_as_json(array: Column) -> Column:
    return F.to_json(array)


def array_as_rows(df: DataFrame, array: Column, name: str) -> DataFrame:
    """One row per element; a row with an empty or NULL array stays, with NULL."""
    return df.select("*", F.explode_outer(array).alias(name))


def array_as_child(df: DataFrame, keys: list[str], array: Column, name: str) -> DataFrame:
    """Child table (keys, position, element); parents without elements have no child rows."""
    return df.select(*keys, F.posexplode(array).alias("position", name))
