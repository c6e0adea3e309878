"""Fit a result to its target: column order, assignment casts, NOT NULL defaults."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F, types as T

_PLAIN = {
    "string": T.StringType, "bigint": T.LongType, "int": T.IntegerType, "smallint": T.ShortType, "double": T.DoubleType,
    "boolean": T.BooleanType, "date": T.DateType, "timestamp": T.TimestampType, "timestamp_ntz": T.TimestampNTZType,
    "binary": T.BinaryType, "variant": T.VariantType,
}


def column_type(kind: str) -> T.DataType:
    """Type by name; works without a running session, as schemas are module constants."""
    decimal = re.fullmatch(r"decimal\((\d+),\s*(\d+)\)", kind)
    if decimal:
        return T.DecimalType(int(decimal[1]), int(decimal[2]))
    return _PLAIN[kind]()


def target_field(name: str, kind: str, *, comment: str = "", default: object = None, required: bool = False) -> T.StructField:
    """One target column; `default` replaces NULL on assignment."""
    meta: dict[str, object] = {}
    if comment:
        meta["comment"] = comment
    if default is not None:
        meta["default"] = default
    return T.StructField(name, column_type(kind), not required, meta)


def conform(df: DataFrame, target: T.StructType, *, missing_as_null: bool = False) -> DataFrame:
    """Casts round half away from zero; a value that does not fit raises under ANSI mode.

    A target column that the rows lack raises, unless missing_as_null asks for NULL (or its default) there.
    """
    columns = []
    lacking = [f.name for f in target.fields if f.name not in df.columns]
    if lacking and not missing_as_null:
        raise ValueError("the rows lack the target columns " + ", ".join(lacking))
    for field in target.fields:
        value = F.col(f"`{field.name}`") if field.name in df.columns else F.lit(None)
        value = value.cast(field.dataType)
        if "default" in field.metadata:
            value = F.coalesce(value, F.lit(field.metadata["default"]).cast(field.dataType))
        columns.append(value.alias(field.name, metadata=field.metadata))
    return df.select(*columns)
