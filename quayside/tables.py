"""Table declarations: declared column types, defaults, generated columns and keys."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import dates, scalars

# --- fixed values: declared type -> target type, first match wins ---------------------------
TARGET_RULES = (
    (r"BOOL.*", "boolean"),
    (r"(DATETIME|TIMESTAMP).*", "timestamptz"),
    (r"DATE", "date"),
    (r"TIME", "time"),
    (r"UUID", "uuid"),
    (r"JSON.*", "text"),
    (r".*INT.*", "bigint"),
    (r".*(CHAR|CLOB|TEXT|STRING).*", "text"),
    (r".*(BLOB|BINARY).*", "bytea"),
    (r"(NUMERIC|DECIMAL).*", "numeric"),
    (r".*(REAL|FLOA|DOUB).*", "double precision"),
)
# Type names of the target itself; they map to themselves.
TARGET_NAMES = (
    r"BYTEA|TSVECTOR|JSONB|BIGSERIAL|SERIAL|SMALLSERIAL|DOUBLE PRECISION|TIMESTAMPTZ|"
    r"TIMESTAMP(TZ)? WITH(OUT)? TIME ZONE|CHARACTER VARYING(\(\d+\))?|INET|CIDR|MACADDR|INTERVAL|"
    r"MONEY|POINT|XML|BIT(\(\d+\))?|VARBIT|BOX|LINE|PATH|POLYGON|CIRCLE|TSQUERY|OID|NAME|REGCLASS"
)
SPARK_TYPES = {
    "boolean": "boolean",
    "timestamptz": "timestamp",
    "date": "date",
    "bigint": "bigint",
    "bigserial": "bigint",
    "serial": "bigint",
    "smallserial": "bigint",
    "bytea": "binary",
    "double precision": "double",
}
# Spellings of "the current time" as a column default.
NOW_DEFAULTS = (
    "current_timestamp",
    "datetime('now')",
    "strftime('%y-%m-%dt%h:%m:%fz','now')",
    "strftime('%y-%m-%dt%h:%m:%sz','now')",
    "strftime('%y-%m-%dt%h:%m:%f','now')",
    "strftime('%y-%m-%dt%h:%m:%s','now')",
)
EPOCH_DEFAULTS = ("strftime('%s','now')", "unixepoch()", "unixepoch('now')")
# -------------------------------------------------------------------------------------------

_MODIFIERS = r"((?:,\s*'[^']*')*)"
_NOW_CALL = re.compile(rf"(datetime|date)\(\s*'now'\s*{_MODIFIERS}\s*\)", re.IGNORECASE)
_FORMATTED = re.compile(rf"strftime\(\s*'([^']*)'\s*,\s*'now'\s*{_MODIFIERS}\s*\)", re.IGNORECASE)
_RANDOM = re.compile(r"(lower\()?(hex\()?randomblob\((\d+)\)\)*", re.IGNORECASE)


def target_type(declared: str, json: str = "text") -> str:
    """The target type of a declared type; an unknown declaration is text."""
    name = " ".join(declared.split()).upper()
    if not name:
        return "text"
    if re.fullmatch(TARGET_NAMES, name) or name.endswith("[]"):
        return name.lower()
    if name.startswith("JSON"):
        return json
    for pattern, target in TARGET_RULES:
        if re.fullmatch(pattern, name):
            sizes = re.search(r"\(([^)]*)\)", name)
            return f"numeric({sizes[1].strip()})" if target == "numeric" and sizes else target
    return "text"


def spark_type(target: str) -> T.DataType:
    """The Spark type that holds a target type."""
    if target.startswith("numeric"):
        sizes = re.search(r"\(([^)]*)\)", target)
        if sizes is None:
            return T.DecimalType(38, 18)
        numbers = [int(n) for n in sizes[1].split(",")]
        return T.DecimalType(numbers[0], numbers[1] if len(numbers) > 1 else 0)
    if target.startswith("timestamp"):
        return T.TimestampType()
    return T.DataType.fromDDL(SPARK_TYPES.get(target, "string"))


NOCASE = T.StringType("UTF8_LCASE")


def folded(kind: T.DataType) -> bool:
    """Whether texts of a type are compared without their case."""
    return isinstance(kind, T.StringType) and kind.collation == NOCASE.collation


def _inner(text: str) -> str:
    """A default expression without outer parentheses."""
    text = text.strip()
    return text[1:-1].strip() if text.startswith("(") and text.endswith(")") else text


def _bare(text: str) -> str:
    """The inner expression in lower case, without blanks."""
    return re.sub(r"\s+", "", _inner(text)).lower()


def is_now_default(default: Any) -> bool:
    """Whether a default is one of the spellings of the current time, shifted or not."""
    if not isinstance(default, Expr):
        return False
    bare = _bare(default.text)
    return bare in NOW_DEFAULTS or bare.startswith("datetime('now'")


_ZERO_OR_ONE = re.compile(r'''[(\s]*[`"\[]?(\w+)[`"\]]?\s+in\s*\(\s*(?:0\s*,\s*1|1\s*,\s*0)\s*\)[)\s]*''', re.IGNORECASE)


@dataclass(frozen=True)
class Expr:
    """A default given as a known function call, such as ``Expr("datetime('now', '+7 days')")``.

    A plain string default is a text literal.
    """

    text: str

    def column(self, now: Any = None, kind: T.DataType | None = None) -> Column:
        bare, inner = _bare(self.text), _inner(self.text)
        if bare in NOW_DEFAULTS:
            return dates.moment(now)
        if bare in EPOCH_DEFAULTS:
            return dates.unixepoch(now)
        if bare == "current_date":
            return dates.date(now=now)
        if bare == "current_time":
            return dates.strftime("%H:%M:%S", now)
        if call := _NOW_CALL.fullmatch(inner):
            modifiers = re.findall(r"'([^']*)'", call[2])
            shifted = dates.datetime(*modifiers, now=now)
            return shifted if call[1].lower() == "datetime" else shifted.cast("date")
        if call := _FORMATTED.fullmatch(inner):
            modifiers = re.findall(r"'([^']*)'", call[2])
            if isinstance(kind, T.TimestampType):  # formatted text is no timestamp default
                return dates.datetime(*modifiers, now=now)
            return dates.strftime(call[1], now, *modifiers)
        if call := _RANDOM.fullmatch(re.sub(r"\s+", "", inner)):
            digits = scalars.random_hex(int(call[3]))
            if not call[2]:
                return F.unhex(digits)
            return digits if call[1] else F.upper(digits)
        raise ValueError(f"default expression not supported: {self.text!r}")


@dataclass(frozen=True)
class Field:
    """One declared column."""

    name: str
    declared: str = ""
    default: Any = None
    not_null: bool = False
    generated: Callable[[], Column] | None = None
    nocase: bool = False  # texts that differ only in case are one key

    def target(self, json: str = "text", promote_text_timestamps: bool = True) -> str:
        target = target_type(self.declared, json)
        if promote_text_timestamps and target == "text" and is_now_default(self.default):
            return "timestamptz"
        return target

    def default_column(self, kind: T.DataType, now: Any = None) -> Column:
        """The value a row gets when the source has no such column."""
        if isinstance(self.default, Expr):
            return self.default.column(now, kind).cast(kind)
        if isinstance(self.default, Column):
            return self.default.cast(kind)
        if isinstance(kind, T.BooleanType) and self.default in (0, 1):
            return F.lit(bool(self.default))
        return F.lit(self.default).cast(kind)


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    """A declared table."""

    name: str
    fields: tuple[Field, ...]
    pk: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    checks: dict[str, Column | str] = field(default_factory=dict)  # conditions, or their SQL text
    json: str = "text"
    promote_text_timestamps: bool = True

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def sound_checks(self) -> dict[str, Column]:
        """The checks as conditions, without those that say that a boolean is 0 or 1.

        Such a check was there because the source had no booleans; a typed column always meets it.
        """
        kept = {}
        for name, test in self.checks.items():
            text = test if isinstance(test, str) else str(test).removeprefix("Column<'").removesuffix("'>")
            zero_or_one = _ZERO_OR_ONE.fullmatch(text)
            column = zero_or_one and next((c for c in self.columns if c.lower() == zero_or_one[1].lower()), None)
            if not (column and self.target(column) == "boolean"):
                kept[name] = F.expr(test) if isinstance(test, str) else test
        return kept

    @property
    def identity(self) -> str | None:
        """The single integer primary key column, which numbers new rows by itself."""
        if len(self.pk) != 1:
            return None
        is_integer = self.target(self.pk[0]) in ("bigint", "bigserial", "serial", "smallserial")
        return self.pk[0] if is_integer else None

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    def target(self, name: str) -> str:
        return self.field(name).target(self.json, self.promote_text_timestamps)

    def type_of(self, name: str) -> T.DataType:
        """The Spark type of a column. A ``nocase`` text carries its comparison in its type, so keys, guards,
        joins and audits over it all follow, and the text itself is stored as it came."""
        kind = spark_type(self.target(name))
        return NOCASE if self.field(name).nocase and isinstance(kind, T.StringType) else kind

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, self.type_of(n)) for n in self.columns])
