"""Scans: delimited text by layout, JSON lines, records of varying shape, Parquet tables, term search."""

from docroll.sources.delimited import read_delimited, write_delimited
from docroll.sources.json_files import read_json_table, schema_text
from docroll.sources.schemas import LAYOUTS, Layout, layout_of, text_keyed
from docroll.sources.search import any_field_matches, search
from docroll.sources.tables import register_tables, table
from docroll.sources.term_index import build_term_index, search_index, term_counts, term_hits
from docroll.sources.varied import read_varied_json, record_fields, typed_fields

__all__ = [
    "LAYOUTS",
    "Layout",
    "any_field_matches",
    "build_term_index",
    "layout_of",
    "read_delimited",
    "read_json_table",
    "read_varied_json",
    "record_fields",
    "register_tables",
    "schema_text",
    "search",
    "search_index",
    "table",
    "term_counts",
    "term_hits",
    "text_keyed",
    "typed_fields",
    "write_delimited",
]
