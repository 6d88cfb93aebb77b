"""Document writers: nested, flat typed, and all-string documents.

The reference writes to a document store and a search index through Hadoop
output formats. Here any Spark data source is the target: ``fmt`` and
``options`` pass straight to ``DataFrameWriter``, so an installed store
connector is used the same way as the default file formats. Writes are
task-parallel and committed by Spark's output committer, so a lost executor
re-runs its tasks without leaving partial files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docroll.functions.scalars import as_strings, string_map


def write_docs(
    df: DataFrame,
    target: str,
    fmt: str = "json",
    mode: str = "overwrite",
    options: Mapping[str, str] | None = None,
    partition_by: Sequence[str] | None = None,
) -> None:
    """Write one document per row. ``mode`` defaults to overwrite, so a rerun
    replaces rather than appends (the reference gives no document id)."""
    writer = df.write.mode(mode).format(fmt)
    if options:
        writer = writer.options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target)


def read_docs(
    spark: SparkSession,
    target: str,
    schema: T.StructType,
    fmt: str = "json",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read documents back with a known schema (no inference pass)."""
    return spark.read.format(fmt).options(**(options or {})).schema(schema).load(target)


def flat_docs(
    df: DataFrame,
    names: Mapping[str, Column | str],
    constants: Mapping[str, object] | None = None,
) -> DataFrame:
    """Flat typed documents: ``{output name: column}`` plus constant fields."""
    cols = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in names.items()]
    cols += [F.lit(v).alias(n) for n, v in (constants or {}).items()]
    return df.select(*cols)


def string_docs(df: DataFrame, names: Mapping[str, Column | str]) -> DataFrame:
    """Flat documents with every value as text (a string map per row, flat)."""
    return as_strings(df, names)


def string_map_docs(
    df: DataFrame, names: Mapping[str, Column | str], into: str = "doc", keep: Sequence[str] = ()
) -> DataFrame:
    """One ``map<string,string>`` per row, behind the columns ``keep``."""
    return df.select(*keep, string_map(names).alias(into))


# Output names whose original spelling had typos (fixed name -> original).
LEGACY_NAMES = {"orderAmount": "orderAmout", "orderLines": "orderlines", "amount": "amout"}


def _renamed(dtype: T.DataType, names: Mapping[str, str]) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType(
            [T.StructField(names.get(f.name, f.name), _renamed(f.dataType, names), f.nullable) for f in dtype.fields]
        )
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_renamed(dtype.elementType, names), dtype.containsNull)
    if isinstance(dtype, T.MapType):
        return T.MapType(dtype.keyType, _renamed(dtype.valueType, names), dtype.valueContainsNull)
    return dtype


def rename_fields(df: DataFrame, names: Mapping[str, str] = LEGACY_NAMES) -> DataFrame:
    """Rename fields at any depth (inside structs, lists of structs, maps).

    One cast per top-level column to the same shape with other field names:
    structs cast by position, so no data is rebuilt by hand.
    """
    cols = []
    for f in df.schema.fields:
        target = _renamed(f.dataType, names)
        c = F.col(f.name) if target == f.dataType else F.col(f.name).cast(target)
        cols.append(c.alias(names.get(f.name, f.name)))
    return df.select(*cols)
