"""Lenient typed coercion: loosely typed values in, one fixed type out.

Every function maps a column to the coerced value and a test for refusal: whether the input had
content which the target type cannot hold and which a typed server would have turned down.
Values that are defined to become NULL (an empty string in an integer column, say) are not
refused. Everything is a native expression; nothing leaves the JVM.

Text is stripped once: callers that run several expressions over a column pass ``strip(x)``
from an earlier projection as ``s``.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------------------
# White space that surrounds a number or a flag without meaning anything.
BLANKS = (
    "\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
TRUE_WORDS = ("1", "true", "t", "yes", "y")
FALSE_WORDS = ("0", "false", "f", "no", "n")
# An epoch at or above this magnitude is in milliseconds, below it in seconds.
MILLIS_FROM = 1e11
LARGEST_DOUBLE = 1.7976931348623157e308
# Largest representable instant, in milliseconds either side of 1970.
MAX_INSTANT_MS = 8.64e15

DECIMAL_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
WHOLE_NUMBER = r"^[+-]?\d+$"
RADIX_NUMBER = r"^0([xX][0-9a-fA-F]+|[oO][0-7]+|[bB][01]+)$"
RADIX = {"x": 16, "o": 8, "b": 2}
EPOCH_NUMBER = r"^-?\d+(\.\d+)?$"
TIMESTAMP_TEXT = (
    r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)
UUID_HEX = r"^[0-9a-f]{32}$"
# -------------------------------------------------------------------------------------------

INTEGER_TARGETS = {"bigint": "bigint", "integer": "int", "smallint": "smallint"}
STRICT_JSON = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "allowUnquotedControlChars": "false",
}
FLOAT_TARGETS = {"double precision": "double", "real": "float"}


class Coerced(NamedTuple):
    """A coerced value, and whether the input was refused given that value's column."""

    value: Column
    refusal: Callable[[Column], Column]

    @property
    def refused(self) -> Column:
        return self.refusal(self.value)


def _never(_: Column) -> Column:
    return F.lit(False)


def strip(x: Column) -> Column:
    """Text without surrounding blanks; plain ASCII ends are told apart without a search."""
    ends = F.ascii(x).between(33, 126) & F.ascii(F.right(x, F.lit(1))).between(33, 126)
    return F.when(ends, x).otherwise(F.btrim(x, F.lit(BLANKS)))


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _is_text(source: T.DataType) -> bool:
    return isinstance(source, (T.StringType, T.BinaryType))


def _as_text(x: Column, source: T.DataType) -> Column:
    return x.cast("string") if isinstance(source, T.BinaryType) else x


def _radix_value(s: Column, kind: str) -> Column:
    """Hexadecimal, octal and binary literals."""
    letter = F.lower(F.substring(s, 2, 1))
    base = F.when(letter == "x", RADIX["x"]).when(letter == "o", RADIX["o"]).otherwise(RADIX["b"])
    digits = F.regexp_replace(F.substr(s, F.lit(3)), "^0+(?=.)", "")
    # `conv` holds 64 bits; longer literals are out of range, or doubles folded in from groups.
    fits = F.length(digits) <= F.when(letter == "x", 16).when(letter == "o", 21).otherwise(64)
    value = F.when(fits, F.call_function("conv", F.when(fits, digits), base, F.lit(10)).try_cast(kind))
    if kind == "double":
        group = lambda i: F.substr(digits, i, F.lit(10))
        folded = F.aggregate(
            F.sequence(F.lit(1), F.length(digits), F.lit(10)),
            F.lit(0.0),
            lambda held, i: held * F.pow(base.cast("double"), F.length(group(i)).cast("double"))
            + F.call_function("conv", group(i), base, F.lit(10)).cast("double"),
        )
        value = F.when(fits, value).otherwise(_finite(folded))
    return F.when(s.rlike(RADIX_NUMBER), value)


def _finite(x: Column) -> Column:
    """NULL instead of NaN or an infinity; NaN compares as larger than every number."""
    return F.when(F.abs(x.cast("double")) <= F.lit(LARGEST_DOUBLE), x)


def _text_number(text: Column, s: Column, kind: str) -> Column:
    """A number in text. A failing cast costs far more than a pattern, so each cast has one."""
    decimal = s.try_cast(kind)
    return (
        F.when(s.rlike(DECIMAL_NUMBER), _finite(decimal) if kind == "double" else decimal)
        .when(text == "", _null(kind))
        .when(s == "", F.lit(0).cast(kind))
        .otherwise(_radix_value(s, kind))
    )


def to_integer(
    x: Column, source: T.DataType, target: str = "bigint", s: Column | None = None
) -> Coerced:
    """Integers; fractions are cut off toward zero.

    Whole-number text stays exact over the full 64 bits.
    """
    kind = INTEGER_TARGETS[target]
    if isinstance(source, T.BooleanType):
        return Coerced(F.when(x, F.lit(1).cast(kind)), _never)
    if _is_text(source):
        text = _as_text(x, source)
        s = strip(text) if s is None else s
        value = (
            F.when(s.rlike(WHOLE_NUMBER), s.try_cast(kind))
            .when(s.rlike(DECIMAL_NUMBER), s.try_cast("double").try_cast(kind))
            .when(text == "", _null(kind))
            .when(s == "", F.lit(0).cast(kind))
            .otherwise(_radix_value(s, kind))
        )
        return Coerced(value, lambda v: v.isNull() & _text_number(text, s, "double").isNotNull())
    return Coerced(x.try_cast(kind), lambda v: v.isNull() & _finite(x).isNotNull())


def _to_number(x: Column, source: T.DataType, kind: str, s: Column | None = None) -> Column:
    if _is_text(source):
        text = _as_text(x, source)
        return _text_number(text, strip(text) if s is None else s, kind)
    if isinstance(source, T.BooleanType):
        return x.cast("int").cast(kind)
    return _finite(x.try_cast(kind)) if kind == "double" else x.try_cast(kind)


def to_float(
    x: Column, source: T.DataType, target: str = "double precision", s: Column | None = None
) -> Coerced:
    """Doubles (or 32-bit reals); what is not finite becomes NULL."""
    wide = _to_number(x, source, "double", s)
    if FLOAT_TARGETS[target] == "double":
        return Coerced(wide, _never)
    return Coerced(_finite(wide.cast("float")), lambda v: v.isNull() & wide.isNotNull())


def to_decimal(
    x: Column, source: T.DataType, precision: int = 38, scale: int = 18, s: Column | None = None
) -> Coerced:
    """Exact decimals, rounded half away from zero to the scale."""
    value = _to_number(x, source, f"decimal({precision},{scale})", s)
    return Coerced(value, lambda v: v.isNull() & _to_number(x, source, "double", s).isNotNull())


def to_boolean(x: Column, source: T.DataType, s: Column | None = None) -> Coerced:
    """Flags: any non-zero number is true; text must be one of the known words."""
    if isinstance(source, T.BooleanType):
        return Coerced(x, _never)
    if _is_text(source):
        word = F.lower(strip(_as_text(x, source)) if s is None else s)
        value = F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(
            word.isin(*FALSE_WORDS), F.lit(False)
        )
        return Coerced(value, _never)
    return Coerced(x != F.lit(0), _never)


def _epoch(n: Column) -> Column:
    """Seconds or milliseconds since 1970 as a timestamp; NULL when out of range."""
    ms = F.when(F.abs(n) >= F.lit(MILLIS_FROM), n).otherwise(n * F.lit(1000.0))
    return F.when(F.abs(ms) <= F.lit(MAX_INSTANT_MS), F.timestamp_millis(ms.cast("bigint")))


def to_timestamp(x: Column, source: T.DataType, s: Column | None = None) -> Coerced:
    """Instants: epoch numbers by magnitude, or timestamp text (UTC when it names no zone)."""
    if isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return Coerced(x.cast("timestamp"), _never)
    if isinstance(source, T.BooleanType):
        return Coerced(_null("timestamp"), lambda v: x.isNotNull())
    if _is_text(source):
        text = _as_text(x, source)
        s = strip(text) if s is None else s
        epoch = F.lit(False) if isinstance(source, T.BinaryType) else s.rlike(EPOCH_NUMBER)
        value = F.when(epoch, _epoch(s.try_cast("double"))).when(
            s.rlike(TIMESTAMP_TEXT), F.try_to_timestamp(s)
        )
        return Coerced(value, lambda v: v.isNull() & text.isNotNull() & (text != "") & ~epoch)
    return Coerced(_epoch(x.cast("double")), _never)


def to_date(x: Column, source: T.DataType, s: Column | None = None) -> Coerced:
    """Dates: the UTC day of an epoch, or the day written in the text whatever its zone."""
    instant = to_timestamp(x, source, s)
    day = instant.value.cast("date")
    if not _is_text(source):
        return Coerced(day, instant.refusal)
    s = strip(_as_text(x, source)) if s is None else s
    written = F.when(F.try_to_timestamp(s).isNotNull(), F.substring(s, 1, 10).try_cast("date"))
    return Coerced(F.when(s.rlike(TIMESTAMP_TEXT), written).otherwise(day), instant.refusal)


def number_text(x: Column, source: T.DataType) -> Column:
    """Numbers in their shortest plain spelling: ``1`` not ``1.0``, exponents from 1e21 on."""
    if not isinstance(source, (T.DoubleType, T.FloatType)):
        return x.cast("string")
    d = x.cast("double")
    raw = x.cast("string")
    size = F.abs(d)

    def plain(scale: int) -> Column:
        digits = raw.try_cast(f"decimal(38,{scale})").cast("string")
        return F.rtrim(F.rtrim(digits, F.lit("0")), F.lit("."))

    mantissa = F.regexp_replace(raw, r"\.0E", "E")
    exponent = F.replace(F.replace(mantissa, F.lit("E-"), F.lit("e-")), F.lit("E"), F.lit("e+"))
    return (
        F.when(F.isnan(d) | (size == F.lit(float("inf"))), raw)
        .when(d == 0, F.lit("0"))
        .when((size >= 1e21) | (size < 1e-6), exponent)
        .when(size >= 1, plain(16))
        .otherwise(plain(24))
    )


def to_text(x: Column, source: T.DataType) -> Coerced:
    """Text: bytes are read as UTF-8, NUL characters dropped, numbers spelled plainly."""
    if isinstance(source, T.BinaryType):
        text = F.make_valid_utf8(x.cast("string"))
    elif isinstance(source, T.StringType):
        text = x
    else:
        return Coerced(number_text(x, source), _never)
    return Coerced(F.replace(text, F.lit("\u0000"), F.lit("")), _never)


def to_uuid(x: Column, source: T.DataType) -> Coerced:
    """UUID text in its canonical lower-case form; braces and odd hyphens are accepted."""
    text = to_text(x, source).value
    h = F.lower(F.regexp_replace(F.btrim(text, F.lit("{}")), "-", ""))
    parts = [F.substring(h, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    value = F.when(h.rlike(UUID_HEX), F.concat_ws("-", *parts))
    return Coerced(value, lambda v: v.isNull() & text.isNotNull())


def to_binary(x: Column, source: T.DataType) -> Coerced:
    """Bytes: kept as they are, or the UTF-8 bytes of the text."""
    if isinstance(source, T.BinaryType):
        return Coerced(x, _never)
    return Coerced(F.encode(number_text(x, source), "utf-8"), _never)


def is_json(text: Column) -> Column:
    """Whether the text is exactly one JSON document.

    Spark's readers stop after the first value. Inside an array and inside an object the text
    must end where the wrapping ends, which leaves no room for anything after the value.
    """
    in_array = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    wrapped = F.concat(F.lit('{"x":'), text, F.lit("}"))
    in_object = F.from_json(wrapped, "x string", STRICT_JSON)["x"].isNotNull()
    return F.coalesce(in_array & (in_object | (strip(text) == "null")), F.lit(False))


def to_json_text(x: Column, source: T.DataType, strict: bool = False) -> Coerced:
    """JSON text: an empty string is NULL, nested values are written out.

    With ``strict`` a text that is not JSON is refused, as a typed JSON column would.
    """
    if isinstance(source, (T.StructType, T.MapType, T.ArrayType)):
        return Coerced(F.to_json(x, {"ignoreNullFields": "false"}), _never)
    if isinstance(source, T.BinaryType):
        text = F.make_valid_utf8(x.cast("string"))
    elif isinstance(source, T.StringType):
        text = F.nullif(x, F.lit(""))
    else:
        return Coerced(number_text(x, source), _never)
    if not strict:
        return Coerced(text, _never)
    return Coerced(F.when(is_json(text), text), lambda v: v.isNull() & text.isNotNull())


STRIPPED_TARGETS = ("numeric", "boolean", "timestamp", "date")


def reads_stripped(source: T.DataType, target: str) -> bool:
    """Whether coercing to the target looks at the text without its surrounding blanks."""
    numbers = target in INTEGER_TARGETS or target in FLOAT_TARGETS
    return _is_text(source) and (numbers or target.startswith(STRIPPED_TARGETS))


def coerce(x: Column, source: T.DataType, target: str, s: Column | None = None) -> Coerced:
    """Coerce a column of Spark type ``source`` to the named target type."""
    name, _, args = target.partition("(")
    if name in INTEGER_TARGETS:
        return to_integer(x, source, name, s)
    if name in FLOAT_TARGETS:
        return to_float(x, source, name, s)
    if name == "numeric":
        sizes = [int(a) for a in args.rstrip(")").split(",")] if args else [38, 18]
        return to_decimal(x, source, sizes[0], sizes[1] if len(sizes) > 1 else 0, s)
    if name == "boolean":
        return to_boolean(x, source, s)
    if name.startswith("timestamp"):
        return to_timestamp(x, source, s)
    if name == "date":
        return to_date(x, source, s)
    if name == "bytea":
        return to_binary(x, source)
    if name in ("json", "jsonb"):
        return to_json_text(x, source, strict=True)
    if name == "uuid":
        return to_uuid(x, source)
    if isinstance(source, (T.StructType, T.MapType, T.ArrayType)):
        return to_json_text(x, source)
    return to_text(x, source)
