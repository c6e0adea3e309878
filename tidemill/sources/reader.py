"""Scans: files, catalog tables, views and inline rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_source(spark: SparkSession, kind: str, location: str, *, alias: str | None = None,
                file_format: str = "parquet", schema: T.StructType | str | None = None,
                **options: str) -> DataFrame:
    """Read a source of kind Table, View or File (an object-store path is a File too)."""
    wanted = kind.upper()
    if wanted in ("TABLE", "VIEW"):
        df = spark.table(location)
    elif wanted in ("FILE", "S3"):
        reader = spark.read.format(file_format).options(**options)
        df = (reader.schema(schema) if schema is not None else reader).load(location)
    else:
        raise ValueError(f"no reader for source kind {kind!r}")
    return df.alias(alias) if alias else df


def view_source(df: DataFrame, name: str) -> DataFrame:
    """Publish a DataFrame as a session view and read it back by name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, date):
        return f"DATE '{value:%Y-%m-%d}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def values_relation(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence[object]]) -> DataFrame:
    """Inline rows as a VALUES relation.

    Catalyst knows the exact size of such a relation, so it is broadcast by size,
    not by hint.
    """
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(f"`{c}`" for c in columns)
    return spark.sql(f"SELECT * FROM VALUES {body} AS inline_rows({names})")


def typed_rows(spark: SparkSession, rows: Sequence[Mapping[str, object]], schema: T.StructType) -> DataFrame:
    """A few typed rows (log and state rows) made of literals in the JVM; missing fields are NULL."""
    def literal(value: object):
        # as text, a datetime keeps its wall clock whatever the driver's zone is
        return F.lit(value.isoformat(sep=" ") if isinstance(value, datetime) else value)

    packed = [
        F.struct(*[literal(row.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]) for row in rows
    ]
    one = spark.range(1)
    if not packed:
        return one.limit(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return one.select(F.explode(F.array(*packed)).alias("r")).select("r.*")
