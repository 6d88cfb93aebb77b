"""JSON records of varying shape: read as VARIANT, their fields and types found in
one pass, typed columns taken out, the rest kept.

``read_json_table`` gives every record one struct, so fields that only some records
have become null columns, and a field that is a number here and text there becomes
text. Here a record stays a VARIANT value until a query asks for a field.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docroll.sources.json_files import BAD_JSON_POLICIES

RECORD = "record"
#: Levels of nesting that ``record_fields`` takes apart; what lies deeper is typed as a whole.
DEPTH = 4


def read_varied_json(spark: SparkSession, path: str, on_bad: str = "fail") -> DataFrame:
    """JSON lines as one VARIANT column ``record``, with no pass for a schema. Blank
    lines are no records. A line that is not JSON raises when its row is read
    (``on_bad='fail'``) or is a null record (``'null'``)."""
    if on_bad not in BAD_JSON_POLICIES:
        raise ValueError(f"on_bad must be one of {BAD_JSON_POLICIES}")
    blank = F.trim("value") == ""
    value = F.when(~blank, F.col("value"))  # Spark may move the filter behind the parser
    return spark.read.text(path).where(~blank).select((F.parse_json(value) if on_bad == "fail" else F.try_parse_json(value)).alias(RECORD))


def _step(key: str, pos: str) -> Column:
    """The path element of an exploded row: ``.key``, ``['a key']``, or ``[*]`` of an array."""
    named = F.when(F.col(key).rlike("^[A-Za-z_][A-Za-z0-9_]*$"), F.concat(F.lit("."), F.col(key)))
    return F.when(F.col(pos).isNull(), F.lit("")).otherwise(F.coalesce(named, F.concat(F.lit("['"), F.replace(F.col(key), F.lit("'"), F.lit("\\'")), F.lit("']")), F.lit("[*]")))


def record_fields(records: DataFrame, depth: int = DEPTH) -> DataFrame:
    """path, type, n: every path that ends in a scalar (or an empty list or object) and
    the least type that holds all values found there; n counts the values.

    A path with integers and decimals is a decimal, one with numbers and text a
    VARIANT; only JSON nulls give VOID. Objects and arrays deeper than ``depth`` levels
    are typed as a whole. All levels are taken apart within the scan's stage and types
    merge before the one shuffle, so a path that every record has costs one row a map task.
    """
    spark = records.sparkSession
    at = records.where(F.col(RECORD).isNotNull()).select(F.lit("$").alias("path"), F.col(RECORD).alias("value"))
    for _ in range(depth):
        opened = at.lateralJoin(spark.tvf.variant_explode_outer(F.col("value").outer()).toDF("pos", "key", "inner"))
        at = opened.select(F.concat("path", _step("key", "pos")).alias("path"), F.when(F.col("pos").isNull(), F.col("value")).otherwise(F.col("inner")).alias("value"))
    return at.groupBy("path").agg(F.schema_of_variant_agg("value").alias("type"), F.count(F.lit(1)).alias("n"))


def _fits(value: Column, dtype: T.DataType) -> Column:
    """Whether a VARIANT value is of the kind of ``dtype``: text is no number, and a
    decimal no integer, although a cast would make it one."""
    kind = F.schema_of_variant(value)
    if isinstance(dtype, T.IntegralType):
        return kind == "BIGINT"
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    if isinstance(dtype, T.StringType):
        return kind == "STRING"
    if isinstance(dtype, T.BooleanType):
        return kind == "BOOLEAN"
    return F.lit(True)


def typed_fields(records: DataFrame, fields: Mapping[str, str], rest: str = "rest") -> DataFrame:
    """``records`` with a typed column for each top-level field in ``fields`` (name → type)
    and in ``rest`` what was not taken.

    A value that is not of its column's type, or does not fit it, gives null and stays
    in ``rest`` as it was; so do fields not asked for. Nothing is lost: typed columns and ``rest``
    together hold every value (decimals rounded to the type asked for). A record that is no
    object stays in ``rest`` as a whole; a null record gives nulls.
    """
    names = [*records.columns, *fields, rest]
    clash = {n for n in names if names.count(n) > 1}
    if clash:
        raise ValueError(f"column names used twice: {sorted(clash)}")
    by_name = F.expr(f"try_cast({RECORD} AS MAP<STRING, VARIANT>)")
    out = records.withColumn("__fields", by_name)
    kept = "__fields"
    typed, taken = [], []
    for name, dtype in fields.items():
        value = F.col(kept)[name]
        got = F.when(_fits(value, T.DataType.fromDDL(dtype)), F.try_variant_get(value, "$", dtype))
        typed.append(got.alias(name))
        taken.append(F.when(got.isNotNull(), F.lit(name)))
    gone = F.array_compact(F.array(*taken)) if taken else F.array().cast("array<string>")
    left = F.map_filter(kept, lambda k, _: ~F.array_contains(gone, k))
    others = F.when(F.col(kept).isNull(), F.col(RECORD)).otherwise(F.to_variant_object(left))
    return out.select(*[F.col(f"`{c}`") for c in records.columns], *typed, others.alias(rest))
