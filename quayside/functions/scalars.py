"""Scalar functions, casts and text predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# CAST(x AS <name>): the integer is 64 bits wide.
CAST_TYPES = {"integer": "bigint", "int": "bigint", "real": "double", "blob": "binary", "text": "string"}

_DIGEST_HEX = 64


def hex_text(x: Column) -> Column:
    """Upper-case hexadecimal of the bytes; numbers are read as their text."""
    return F.hex(x.cast("string").cast("binary"))


def random_hex(n_bytes: int) -> Column:
    """A random lower-case hexadecimal id of ``n_bytes`` bytes, one per row.

    Each 32-byte piece is a digest of a random UUID (122 random bits): good for ids, not for keys.
    """
    pieces = -(-2 * n_bytes // _DIGEST_HEX)
    digests = [F.sha2(F.uuid(), 256) for _ in range(pieces)]
    whole = digests[0] if pieces == 1 else F.concat(*digests)
    return F.substring(whole, 1, 2 * n_bytes)


def random_blob(n_bytes: int) -> Column:
    """``n_bytes`` random bytes per row."""
    return F.unhex(random_hex(n_bytes))


def ifnull(a: Column, b: Column) -> Column:
    return F.coalesce(a, b)


def instr(text: Column, part: Column) -> Column:
    """Position of the first occurrence counted from 1, or 0."""
    return F.instr(text, part)


def scalar_max(*values: Column) -> Column:
    """The largest argument; NULL arguments are skipped."""
    return F.greatest(*values)


def scalar_min(*values: Column) -> Column:
    """The smallest argument; NULL arguments are skipped."""
    return F.least(*values)


def cast_as(x: Column, type_name: str) -> Column:
    """``CAST(x AS INTEGER | INT | REAL | BLOB | TEXT)``; fractions are cut off toward zero."""
    target = CAST_TYPES[type_name.lower()]
    return x.cast("string").cast(target) if target == "binary" else x.cast(target)


def like(x: Column, pattern: str, escape: str | None = None) -> Column:
    """``LIKE`` without regard to case; negate with ``~`` for ``NOT LIKE``."""
    if escape is None:
        return F.ilike(x, F.lit(pattern))
    return F.ilike(x, F.lit(pattern), F.lit(escape))


def regexp(x: Column, pattern: str) -> Column:
    """``REGEXP``: a case-sensitive match anywhere in the text."""
    return x.rlike(pattern)
