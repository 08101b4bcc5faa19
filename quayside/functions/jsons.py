"""JSON functions over JSON text."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP = re.compile(r"""\."(?P<quoted>[^"]*)"|\.(?P<plain>[^.\[]+)|\[(?P<index>\d+)\]""")
_TYPES = {str: "^STRING", bool: "^BOOLEAN", int: "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"}


def json_path(path: str) -> str:
    """Check a ``$.a."b c"[0]`` path and spell it the way Spark reads it."""
    if not path.startswith("$"):
        raise ValueError(f"JSON path must start with $: {path!r}")
    at, out = 1, "$"
    while at < len(path):
        step = _STEP.match(path, at)
        if step is None:
            raise ValueError(f"JSON path not supported: {path!r}")
        if step["index"] is not None:
            out += f"[{step['index']}]"
        else:
            key = step["quoted"] if step["quoted"] is not None else step["plain"]
            out += f"['{key}']"
        at = step.end()
    return out


def json_extract(x: Column, path: str) -> Column:
    """The value at a path as text; JSON null and a missing path are NULL."""
    return F.get_json_object(x, json_path(path))


def json_array_length(x: Column, path: str = "$") -> Column:
    """The number of elements of an array; NULL when there is no array."""
    if path == "$":
        return F.json_array_length(x)
    # By kind: a string that looks like an array is none.
    found = F.try_variant_get(F.try_parse_json(x), json_path(path), "array<variant>")
    return F.when(found.isNotNull(), F.size(found))


def json_value(x: Column) -> Column:
    """One value spelled as JSON text; NULL becomes ``null``."""
    wrapped = F.to_json(F.array(x), {"ignoreNullFields": "false"})
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def json_array(*values: Column) -> Column:
    """A JSON array of values of any types."""
    return F.concat(F.lit("["), F.concat_ws(",", *[json_value(v) for v in values]), F.lit("]"))


def json_member(key: Column, value: Column) -> Column:
    """One ``"key":value`` pair; a NULL key is an error."""
    name = F.coalesce(key.cast("string"), F.raise_error("JSON object key is NULL").cast("string"))
    return F.concat(json_value(name), F.lit(":"), json_value(value))


def json_object(*pairs: Column) -> Column:
    """A JSON object from alternating keys and values; repeated keys are kept."""
    if len(pairs) % 2:
        raise ValueError("json_object needs an even number of arguments")
    members = [json_member(k, v) for k, v in zip(pairs[::2], pairs[1::2])]
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def json_contains(x: Column, part: Any) -> Column:
    """Whether the document holds ``part``: objects by key, arrays by element, scalars by value.

    Types count: the text ``"1"`` does not contain the number ``1``. The document is read once,
    however many keys are asked for.
    """
    return F.coalesce(F.exists(F.array(F.try_parse_json(x)), _holder(part)), F.lit(False))


def _holds(doc: Column, path: str, part: Any) -> Column:
    node = F.try_variant_get(doc, path, "variant")
    kind = F.schema_of_variant(node)
    if isinstance(part, dict):
        test = kind.startswith("OBJECT")
        for key, value in part.items():
            test = test & _holds(doc, f"{path}['{key}']", value)
        return test
    if isinstance(part, list):
        elements = F.try_variant_get(doc, path, "array<variant>")
        test = kind.startswith("ARRAY")
        for value in part:
            test = test & F.exists(elements, _holder(value))
        return test
    if part is None:
        return kind == "VOID"
    for python_type in (bool, str):
        if isinstance(part, python_type):
            same = F.try_variant_get(doc, path, "string") == F.lit(
                str(part).lower() if python_type is bool else part
            )
            return kind.rlike(_TYPES[python_type]) & same
    return kind.rlike(_TYPES[int]) & (F.try_variant_get(doc, path, "double") == F.lit(float(part)))


def _holder(part: Any):
    return lambda element: _holds(element, "$", part)
