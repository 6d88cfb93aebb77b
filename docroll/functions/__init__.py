"""Column -> Column functions (all built-in Catalyst expressions, no UDF)."""

from docroll.functions.scalars import (
    REFERENCE_BUCKET_THRESHOLDS,
    REFERENCE_CUTOFF,
    REFERENCE_TS_FORMAT,
    as_strings,
    bucket,
    doc_json,
    exact_sum,
    java_date_text,
    money_sum,
    parse_ts,
    string_map,
    ts_literal,
)

__all__ = [
    "REFERENCE_BUCKET_THRESHOLDS",
    "REFERENCE_CUTOFF",
    "REFERENCE_TS_FORMAT",
    "as_strings",
    "bucket",
    "doc_json",
    "exact_sum",
    "java_date_text",
    "money_sum",
    "parse_ts",
    "string_map",
    "ts_literal",
]
