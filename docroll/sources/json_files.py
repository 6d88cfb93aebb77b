"""JSON-lines scan with an inferred or a known schema, and schema inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BAD_JSON_POLICIES = ("fail", "null")


def read_json_table(
    spark: SparkSession,
    path: str,
    name: str | None = None,
    schema: T.StructType | None = None,
    on_bad: str = "fail",
) -> DataFrame:
    """Read JSON lines; optionally register a view.

    Without ``schema`` it is inferred from every line, one full extra pass over
    the input (JSON integers infer as bigint); with one there is no such pass.
    A line that is not JSON, or (with a schema) a value of another type, raises
    when its row is read (``on_bad='fail'``) or becomes null (``'null'``).
    """
    if on_bad not in BAD_JSON_POLICIES:
        raise ValueError(f"on_bad must be one of {BAD_JSON_POLICIES}")
    reader = spark.read.option("mode", "FAILFAST" if on_bad == "fail" else "PERMISSIVE")
    if on_bad == "null":
        reader = reader.option("columnNameOfCorruptRecord", "__corrupt")
    df = (reader if schema is None else reader.schema(schema)).json(path)
    df = df.drop("__corrupt")
    if name:
        df.createOrReplaceTempView(name)
    return df


def schema_text(df: DataFrame) -> str:
    """The schema tree ``printSchema`` prints, as a string."""
    return df.schema.treeString()
