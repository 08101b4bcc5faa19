"""Date and time functions with the calling conventions of SQLite, in UTC.

``now`` is always a parameter (default: the query's start time), so results can be pinned.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

Moment = "Column | dt.datetime | str | None"

# --- fixed values: format specifiers and their datetime patterns ---------------------------
SPECIFIERS = {
    "Y": "yyyy",
    "m": "MM",
    "d": "dd",
    "H": "HH",
    "M": "mm",
    "S": "ss",
    "f": "ss.SSS",
    "j": "DDD",
    "e": "d",
    "I": "hh",
    "p": "a",
}
ISO_WEEK = "W"
IGNORED_MODIFIERS = ("localtime", "utc")
UNITS = ("second", "minute", "hour", "day", "month", "year")
UNIX_EPOCH_JULIAN_DAY = 2440587.5
# -------------------------------------------------------------------------------------------

_SHIFT = re.compile(rf"([+-]?)\s*(\d+(?:\.\d+)?)\s+({'|'.join(UNITS)})s?", re.IGNORECASE)
_START = re.compile(r"start of (day|month|year)", re.IGNORECASE)


class UnsupportedModifier(ValueError):
    """A date modifier or format specifier outside the supported set."""


def moment(x: Moment = None) -> Column:
    """A point in time as a timestamp column; ``None`` or ``'now'`` is the query's start."""
    if x is None or (isinstance(x, str) and x.lower() == "now"):
        return F.current_timestamp()
    if isinstance(x, Column):
        return x.cast("timestamp")
    return F.lit(str(x)).cast("timestamp")


def _interval(sign: int, amount: str, unit: str) -> Column:
    """One shift as an interval; fractions of months are 30-day months, of years whole months."""
    n = float(amount)
    months, days, seconds = 0, 0, 0.0
    if unit == "year":
        months = 12 * int(n) + round((n - int(n)) * 12)
    elif unit == "month":
        months, rest = int(n), (n - int(n)) * 30
        days, seconds = int(rest), (rest - int(rest)) * 86400
    elif unit == "day":
        days, seconds = int(n), (n - int(n)) * 86400
    else:
        seconds = n * {"hour": 3600, "minute": 60, "second": 1}[unit]
    return F.make_interval(
        months=F.lit(sign * months),
        days=F.lit(sign * days),
        secs=F.lit(f"{sign * seconds:.6f}").cast("decimal(18,6)"),
    )


def shift(ts: Column, *modifiers: str) -> Column:
    """Apply modifiers left to right: ``'-7 days'``, ``'start of month'``, ``'localtime'``."""
    for modifier in modifiers:
        word = modifier.strip()
        if word.lower() in IGNORED_MODIFIERS:
            continue
        if start := _START.fullmatch(word):
            ts = F.date_trunc(start[1].lower(), ts)
        elif step := _SHIFT.fullmatch(word):
            ts = ts + _interval(-1 if step[1] == "-" else 1, step[2], step[3].lower())
        else:
            raise UnsupportedModifier(f"date modifier not supported: {modifier!r}")
    return ts


def datetime(*modifiers: str, now: Moment = None) -> Column:
    """``datetime('now', …)`` as a timestamp."""
    return shift(moment(now), *modifiers)


def naive(ts: Column) -> Column:
    """The UTC wall-clock time, to compare with a column that has no zone.

    Casting the constant and not the column lets the comparison reach the scan.
    """
    return ts.cast("timestamp_ntz")


def date(*modifiers: str, now: Moment = None) -> Column:
    """``date('now', …)`` as a date."""
    return shift(moment(now), *modifiers).cast("date")


def unixepoch(x: Moment = None, *modifiers: str) -> Column:
    """Whole seconds since 1970, rounded down."""
    return F.unix_seconds(shift(moment(x), *modifiers))


def julianday(x: Moment = None, *modifiers: str) -> Column:
    """Days since noon in Greenwich on 24 November 4714 BC, with fraction."""
    micros = F.unix_micros(shift(moment(x), *modifiers))
    return micros / F.lit(86400000000.0) + F.lit(UNIX_EPOCH_JULIAN_DAY)


def strftime(fmt: str, x: Moment = None, *modifiers: str) -> Column:
    """Format a point in time; ``'%s'`` alone gives epoch seconds as an integer."""
    ts = shift(moment(x), *modifiers)
    if fmt == "%s":
        return F.unix_seconds(ts)
    pieces: list[Column] = []
    pattern = literal = ""
    for token in [*re.findall(r"%.|[^%]+|%$", fmt, re.DOTALL), ""]:
        if token == "%%" or token[:1] not in ("%", ""):
            literal += "%" if token == "%%" else token
            continue
        if literal:
            pattern += "'" + literal.replace("'", "''") + "'"
            literal = ""
        if token[1:] in SPECIFIERS:
            pattern += SPECIFIERS[token[1:]]
            continue
        if token not in ("", f"%{ISO_WEEK}"):
            raise UnsupportedModifier(f"format specifier not supported: {token!r}")
        if pattern:
            pieces.append(F.date_format(ts, pattern))
            pattern = ""
        if token:
            pieces.append(F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))
    return pieces[0] if len(pieces) == 1 else F.concat(*pieces) if pieces else F.lit("")
