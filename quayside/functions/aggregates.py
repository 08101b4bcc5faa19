"""Aggregate columns with bounded state; text-building aggregates are in ``operators.grouping``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(x: Column) -> Column:
    """Sum that is 0, not NULL, when there is nothing to add."""
    return F.coalesce(F.sum(x), F.lit(0))
