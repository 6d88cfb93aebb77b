"""Term search over every field of any DataFrame.

The reference sends ``?q=term`` to a search index, which matches the term as
a whole, case-folded token in any field. Here the same predicate is a
Catalyst filter: one regular expression per field, at any depth, OR-ed, evaluated in
the scan's task (no shuffle, no array per row). Against a source that
supports it, the same filter may be pushed into the source.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A token is a run of letters and digits; anything else separates tokens.
_EDGE = r"[^\p{L}\p{N}]"


def term_pattern(term: str) -> str:
    """Regex matching ``term`` as a whole token of lower-cased text."""
    return f"(^|{_EDGE}){re.escape(term.lower())}($|{_EDGE})"


def _matches(value: Column, dtype: T.DataType, pattern: str) -> Column | None:
    """Whether the term occurs in a value, at any depth; None for types without text."""
    if isinstance(dtype, T.StructType):
        hits = [_matches(value.getField(f.name), f.dataType, pattern) for f in dtype.fields]
        return _any([h for h in hits if h is not None])
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        inner = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype.valueType
        items = value if isinstance(dtype, T.ArrayType) else F.map_values(value)
        if _matches(F.lit(None), inner, pattern) is None:
            return None
        return F.coalesce(F.exists(items, lambda x: _matches(x, inner, pattern)), F.lit(False))
    if isinstance(dtype, (T.BinaryType, T.NullType)):
        return None
    return F.coalesce(F.lower(value.cast("string")).rlike(pattern), F.lit(False))


def _any(hits: Sequence[Column]) -> Column | None:
    out = None
    for hit in hits:
        out = hit if out is None else out | hit
    return out


def any_field_matches(df: DataFrame, term: str, columns: Sequence[str] | None = None) -> Column:
    """True where the term is a whole token of any chosen column.

    ``columns`` defaults to all: text, numbers and other values as Spark prints
    them, and the fields of structs, list items and map values at any depth.
    Null fields do not match and never turn the result null.
    """
    chosen = df.columns if columns is None else columns
    hits = [_matches(F.col(f"`{c}`"), df.schema[c].dataType, term_pattern(term)) for c in chosen]
    out = _any([h for h in hits if h is not None])
    return F.lit(False) if out is None else out


def search(df: DataFrame, term: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows where the term matches any field."""
    return df.where(any_field_matches(df, term, columns))
