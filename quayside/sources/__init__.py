"""Reading loosely typed sources and publishing tables."""

from quayside.sources.publish import current_version, latest, publish
from quayside.sources.scan import (
    jdbc_options,
    key_slices,
    read_jdbc,
    read_jdbc_parts,
    read_loose,
    remainder_predicates,
    sliced,
    write_jdbc,
)

__all__ = [
    "current_version",
    "jdbc_options",
    "key_slices",
    "latest",
    "publish",
    "read_jdbc",
    "read_jdbc_parts",
    "read_loose",
    "remainder_predicates",
    "sliced",
    "write_jdbc",
]
