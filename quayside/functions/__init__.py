"""Column functions."""

from quayside.functions import aggregates, coerce, dates, jsons, scalars, sql_names

__all__ = ["aggregates", "coerce", "dates", "jsons", "scalars", "sql_names"]
