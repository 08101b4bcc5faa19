"""Numbers in text against a plain model of how a lenient number reader sees them."""

import random
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.coerce import BLANKS, to_float, to_integer


def model(text):
    """The number in a text, or ``None``; exact for whole numbers."""
    s = text.strip(BLANKS)
    if s == "":
        return 0
    if re.fullmatch(r"[+-]?[0-9]+", s):
        return int(s)
    if re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", s):
        value = float(s)
        return None if value in (float("inf"), float("-inf")) else value
    if radix := re.fullmatch(r"0(?:[xX]([0-9a-fA-F]+)|[oO]([0-7]+)|[bB]([01]+))", s):
        digits = next(g for g in radix.groups() if g)
        value = int(digits, {"x": 16, "o": 8, "b": 2}[s[1].lower()])
        return value if value < 2**64 else 2**64 - 1
    return None


def texts(n):
    rng = random.Random(7)
    atoms = ["", " ", "\t", " ", "+", "-", ".", "e", "E", "0", "1", "7", "9", "42", "003", "x", "0x", "0b", "0o", "f",
             "d", "_", ",", "Infinity", "NaN", "99999999999", "1e5", "e-3", "e400", "\0"]
    made = {"".join(rng.choice(atoms) for _ in range(rng.randrange(1, 6))) for _ in range(n)}
    return sorted(made)


def test_numbers_in_text(spark):
    values = texts(6000)
    frame = spark.createDataFrame([(v,) for v in values], "x string")
    kind, x = T.StringType(), F.col("x")
    whole, real = to_integer(x, kind), to_float(x, kind)
    got = frame.select("x", whole.value.alias("i"), whole.refused.alias("r"), real.value.alias("d")).collect()
    for row in got:
        number = None if row["x"] == "" else model(row["x"])
        if number is None:
            assert (row["i"], row["r"], row["d"]) == (None, False, None), repr(row["x"])
            continue
        cut = int(number)
        fits = -(2**63) <= cut < 2**63
        assert row["d"] == float(number), repr(row["x"])
        assert (row["i"], row["r"]) == ((cut, False) if fits else (None, True)), repr(row["x"])
