"""docroll: customer / order document rollups on Spark DataFrames.

Scans delimited text, JSON and Parquet; rolls order lines up to orders and
orders up to customers; nests child rows into documents; reports orphans;
searches all text fields for a term; writes documents to any Spark sink.
Every operator is DataFrame in, DataFrame out, built from Catalyst
expressions so planning, partial aggregation, shuffles and spills stay
inside Spark.
"""

from docroll.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
