"""Formatting a result the way applications expect it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# --- fixed values: names of result column types ---------------------------------------------
TYPE_WORDS = (
    (T.BooleanType, "BOOLEAN"),
    (T.BinaryType, "BLOB"),
    (T.IntegralType, "INTEGER"),
    (T.StringType, "TEXT"),
    (T.FractionalType, "REAL"),
    (T.DateType, "DATE"),
    ((T.TimestampType, T.TimestampNTZType), "DATETIME"),
)
# -------------------------------------------------------------------------------------------

INT_MODES = ("number", "bigint", "string")
TIMESTAMP_MODES = ("iso", "date")


def iso_text(x: Column) -> Column:
    """A timestamp as ISO text with milliseconds, in UTC."""
    return F.date_format(x.cast("timestamp"), ISO_PATTERN)


def present(rows: DataFrame, int_mode: str = "number", timestamps: str = "iso") -> DataFrame:
    """One projection over the result.

    64-bit integers stay numbers or become text; decimals become doubles, or text when integers
    do; timestamps become ISO text or stay; dates become ``YYYY-MM-DD`` text with ``iso``.
    """
    if int_mode not in INT_MODES or timestamps not in TIMESTAMP_MODES:
        raise ValueError(f"unknown mode: {int_mode!r}, {timestamps!r}")
    out = []
    for f in rows.schema.fields:
        x, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, T.LongType):
            x = x.cast("string") if int_mode == "string" else x
        elif isinstance(kind, T.DecimalType):
            x = x.cast("string" if int_mode == "string" else "double")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)) and timestamps == "iso":
            x = iso_text(x)
        elif isinstance(kind, T.DateType) and timestamps == "iso":
            x = x.cast("string")
        out.append(x.alias(f.name))
    return rows.select(*out)


def type_words(rows: DataFrame) -> list[str]:
    """The declared-type word of each result column, empty where there is none."""
    return [
        next((word for kinds, word in TYPE_WORDS if isinstance(f.dataType, kinds)), "")
        for f in rows.schema.fields
    ]
