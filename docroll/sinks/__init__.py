"""Document sinks (any Spark data source)."""

from docroll.sinks.documents import (
    LEGACY_NAMES,
    flat_docs,
    rename_fields,
    read_docs,
    string_docs,
    string_map_docs,
    write_docs,
)
from docroll.sinks.keyed import merge_by_key, read_keyed, vacuum

__all__ = [
    "LEGACY_NAMES",
    "flat_docs",
    "merge_by_key",
    "read_docs",
    "read_keyed",
    "rename_fields",
    "string_docs",
    "string_map_docs",
    "vacuum",
    "write_docs",
]
