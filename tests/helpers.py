"""Small helpers shared by the tests."""

from __future__ import annotations

from collections import Counter


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def bag(frame):
    return Counter(rows(frame))


def one(frame):
    (row,) = frame.collect()
    return tuple(row)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()
