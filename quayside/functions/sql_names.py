"""The date and JSON functions under their own names in Spark SQL text.

They are SQL functions: Spark replaces each call by its expression, so a call with literal
arguments is folded to the same plan the column functions give. Names Spark already has with the
same meaning (``ifnull``, ``instr``, ``coalesce``, ``json_array_length``, ``regexp``, ``ilike``,
``listagg``) are left to Spark. ``strftime`` always gives text. Spark's own ``date`` takes one argument
and cannot be replaced: ``date('now', '-7 days')`` is spelled ``date_of('now', '-7 days')``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from quayside.functions.dates import IGNORED_MODIFIERS, ISO_WEEK, SPECIFIERS, UNITS, UNIX_EPOCH_JULIAN_DAY

MODIFIERS = 4
_SHIFT = rf"(?i)^\s*([+-]?)\s*(\d+(?:\.\d+)?)\s+({'|'.join(UNITS)})s?\s*$"
_PARAMETERS = ", ".join(f"m{i} STRING DEFAULT NULL" for i in range(1, MODIFIERS + 1))
_PATH = r"""^[$](\."[^"]*"|\.[^.\["]+|\[\d+\])*$"""
_MARK = "\\u0001"  # stands for a quote in the format while the pattern is put together


def _shifted() -> str:
    expression = "t"
    for i in range(1, MODIFIERS + 1):
        expression = f"shift_time({expression}, m{i})"
    return expression


def _pattern() -> str:
    """The datetime pattern for a format: literal text in quotes, specifiers outside them."""
    text = f"replace(replace(fmt, '''', '{_MARK}'), '%%', '\\u0002')"
    for letter, pattern in SPECIFIERS.items():
        text = f"replace({text}, '%{letter}', '''{pattern}''')"
    week = "lpad(cast(weekofyear(t) as string), 2, '0')"
    text = f"replace({text}, '%{ISO_WEEK}', {week})"
    quoted = f"replace(concat('''', {text}, ''''), '''''', '')"
    return f"replace(replace({quoted}, '{_MARK}', ''''''), '\\u0002', '%')"


def _statements() -> dict[str, str]:
    ignored = ", ".join(f"'{w}'" for w in IGNORED_MODIFIERS)
    months = "CASE unit WHEN 'year' THEN 12 * floor(n) + rint((n - floor(n)) * 12) WHEN 'month' THEN floor(n) ELSE 0 END"
    days = "CASE unit WHEN 'day' THEN floor(n) WHEN 'month' THEN floor((n - floor(n)) * 30) ELSE 0 END"
    seconds = (
        "CASE unit WHEN 'day' THEN (n - floor(n)) * 86400 WHEN 'hour' THEN n * 3600 WHEN 'minute' THEN n * 60 "
        "WHEN 'second' THEN n WHEN 'month' THEN ((n - floor(n)) * 30 - floor((n - floor(n)) * 30)) * 86400 ELSE 0 END"
    )
    now = "t TIMESTAMP DEFAULT current_timestamp()"
    return {
        "shift_by": f"""(t TIMESTAMP, sign INT, n DOUBLE, unit STRING) RETURNS TIMESTAMP
            RETURN t + make_interval(0, cast(sign * ({months}) as int), 0, cast(sign * ({days}) as int), 0, 0,
                                     cast(sign * ({seconds}) as decimal(18,6)))""",
        "shift_time": f"""(t TIMESTAMP, modifier STRING) RETURNS TIMESTAMP RETURN CASE
            WHEN modifier IS NULL OR lower(trim(modifier)) IN ({ignored}) THEN t
            WHEN lower(trim(modifier)) IN ('start of day', 'start of month', 'start of year')
              THEN date_trunc(substr(trim(modifier), 10), t)
            WHEN modifier RLIKE r'{_SHIFT}' THEN shift_by(t,
              CASE regexp_extract(modifier, r'{_SHIFT}', 1) WHEN '-' THEN -1 ELSE 1 END,
              try_cast(regexp_extract(modifier, r'{_SHIFT}', 2) as double),
              lower(regexp_extract(modifier, r'{_SHIFT}', 3)))
            ELSE raise_error(concat('date modifier not supported: ', modifier)) END""",
        "datetime": f"({now}, {_PARAMETERS}) RETURNS TIMESTAMP RETURN {_shifted()}",
        "unixepoch": f"({now}, {_PARAMETERS}) RETURNS BIGINT RETURN unix_seconds({_shifted()})",
        "julianday": f"""({now}, {_PARAMETERS}) RETURNS DOUBLE
            RETURN unix_micros({_shifted()}) / 86400000000D + {UNIX_EPOCH_JULIAN_DAY}D""",
        "format_time": f"""(fmt STRING, t TIMESTAMP) RETURNS STRING RETURN CASE
            WHEN fmt = '%s' THEN cast(unix_seconds(t) as string)
            WHEN replace(fmt, '%%', '') RLIKE '%([^{"".join(SPECIFIERS)}{ISO_WEEK}]|$)'
              THEN raise_error(concat('format specifier not supported: ', fmt))
            WHEN fmt = '' THEN '' ELSE date_format(t, {_pattern()}) END""",
        "strftime": f"(fmt STRING, {now}, {_PARAMETERS}) RETURNS STRING RETURN format_time(fmt, {_shifted()})",
        "json_extract": f"""(doc STRING, path STRING) RETURNS STRING RETURN CASE
            WHEN path IS NULL OR path RLIKE r'{_PATH}' THEN get_json_object(doc, regexp_replace(path, r'\\."([^"]*)"', r"['$1']"))
            ELSE raise_error(concat('JSON path not supported: ', path)) END""",
        "date_of": f"({now}, {_PARAMETERS}) RETURNS DATE RETURN cast({_shifted()} as date)",
        "randomblob": """(n INT) RETURNS BINARY
            RETURN unhex(substr(array_join(transform(sequence(1, n div 32 + 1), i -> sha2(uuid(), 256)), ''), 1, 2 * n))""",
    }


def register(spark: SparkSession) -> SparkSession:
    """Create the functions for this session (temporary, no catalog change)."""
    for name, body in _statements().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return spark
