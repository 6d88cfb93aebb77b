"""Term search at the source: a written inverted index and a lookup in two steps.

``build_term_index`` writes two tables below one folder:

* ``terms``: (term, field, key), one row per document, field and distinct token, in
  buckets by the term's hash and sorted by term and key;
* ``docs``: the documents, in buckets by the key's hash and sorted by key.

``search_index`` reads one bucket of ``terms`` for a term (a partition filter; the files'
statistics skip the rest of the bucket), and joins the keys found with ``docs``, whose buckets
are pruned by the keys when those are few enough for Spark to broadcast. What comes back is then tested with the
predicate of ``search`` itself, so both give the same rows, for terms of several tokens too.
A term that very many documents hold is split over files by key, in the index as in the lookup.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docroll.session import remove_path, scratch_path
from docroll.sources.search import _EDGE, any_field_matches, search

BUCKETS = 64
#: Bytes of staged documents whose terms, and that as documents, make one range at most: a
#: range's sort stays in memory, however large the table is.
TERM_RANGE, DOC_RANGE = 4 << 20, 16 << 20
#: Values that Spark prints in ASCII alone.
_PLAIN = (T.NumericType, T.DatetimeType, T.BooleanType)


def _tokens(text: Column, ascii_only: bool) -> Column:
    # a replaced pattern is compiled once a task, a split one for every value unless it is one character
    edge = "[^a-z0-9]+" if ascii_only else f"{_EDGE}+"
    return F.split(F.regexp_replace(F.lower(text), edge, " "), " ")


def _texts(value: Column, dtype: T.DataType, path: str) -> list[tuple[str, Column, bool]]:
    """(field path, text, whether it is ASCII) of every field of a value, at any depth. The
    texts of an array's or a map's values are joined by a space: their tokens are the same."""
    if isinstance(dtype, T.StructType):
        return [leaf for f in dtype.fields for leaf in _texts(value.getField(f.name), f.dataType, f"{path}.{f.name}")]
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        inner = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype.valueType
        items = value if isinstance(dtype, T.ArrayType) else F.map_values(value)

        def text_of(i: int) -> Column:
            return F.array_join(F.transform(items, lambda x: _texts(x, inner, path)[i][1]), " ")

        return [(p, text_of(i), plain) for i, (p, _, plain) in enumerate(_texts(F.lit(None), inner, path))]
    if isinstance(dtype, (T.BinaryType, T.NullType)):
        return []
    return [(path, value.cast("string"), isinstance(dtype, _PLAIN))]


def _numbered(df: DataFrame, key: str, columns: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    """(term, field, key) with each field as its place in the list of names, which is in order."""
    chosen = df.columns if columns is None else list(columns)
    leaves = [leaf for c in chosen for leaf in _texts(F.col(f"`{c}`"), df.schema[c].dataType, c)]
    names = sorted({path for path, _, _ in leaves})
    if not leaves:
        return df.select(F.lit("").alias("term"), F.lit(0).alias("field"), F.col(f"`{key}`").alias("key")).where("term <> ''"), names
    fields = F.array(*[F.struct(F.lit(names.index(path)).alias("field"), F.array_distinct(_tokens(text, plain)).alias("terms")) for path, text, plain in leaves])
    per_field = df.select(F.col(f"`{key}`").alias("key"), F.explode(fields).alias("f"))
    return per_field.select(F.explode("f.terms").alias("term"), F.col("f.field").alias("field"), "key").where("term <> ''"), names


def _named(terms: DataFrame, names: Sequence[str]) -> DataFrame:
    """Field numbers as the names they stand for."""
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("field") + 1) if names else F.lit("")
    return terms.select(*[name.alias(c) if c == "field" else F.col(f"`{c}`") for c in terms.columns])


def term_rows(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(term, field, key): the distinct tokens of each field of each document."""
    return _named(*_numbered(df, key, columns))


def _ranges(spark: SparkSession, path: str, size: int) -> int:
    """The session's partitions, or more if what is written below the path is large."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    written = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-written // size))


def _bucket(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def build_term_index(df: DataFrame, key: str, path: str, columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> None:
    """Write the index of ``df`` below ``path``. ``key`` names documents and should be unique;
    rows that share a key are found together and then tested each by itself."""
    for name in ("term_bucket", "key_bucket"):
        if name in df.columns:
            raise ValueError(f"column {name} exists")
    spark = df.sparkSession
    once = scratch_path(spark, "index-docs")  # read four times below: written once, deleted in the end
    df.write.parquet(once)
    df = spark.read.schema(df.schema).parquet(once)
    numbered, names = _numbered(df, key, columns)
    terms = numbered.withColumn("term_bucket", _bucket(F.col("term"), buckets))
    # a range holds some whole buckets, or a part of a large one; a hot term is split between keys
    order = ["term_bucket", "term", "key", "field"]
    terms = _named(terms.repartitionByRange(_ranges(spark, once, TERM_RANGE), *order).sortWithinPartitions(*order), names)
    terms.write.mode("overwrite").partitionBy("term_bucket").parquet(f"{path}/terms")
    docs = df.withColumn("key_bucket", _bucket(F.col(f"`{key}`"), buckets))
    docs.repartitionByRange(_ranges(spark, once, DOC_RANGE), "key_bucket", F.col(f"`{key}`")).sortWithinPartitions("key_bucket", F.col(f"`{key}`")).write.mode("overwrite").partitionBy("key_bucket").parquet(f"{path}/docs")
    chosen = df.columns if columns is None else list(columns)
    spark.createDataFrame([(key, buckets, chosen, df.columns, df.schema.json(), terms.schema.json())], "key string, buckets int, searched array<string>, columns array<string>, docs string, terms string").coalesce(1).write.mode("overwrite").json(f"{path}/about")
    remove_path(spark, once)


def tokens_of_term(term: str) -> list[str]:
    """The tokens (runs of letters and digits) of a search term, lower-cased."""
    flat = "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in term.lower())
    return sorted(set(flat.split(" ")) - {""})


def _about(spark: SparkSession, path: str):
    schema = "key string, buckets int, searched array<string>, columns array<string>, docs string, terms string"
    return spark.read.schema(schema).json(f"{path}/about").first()


def term_hits(spark: SparkSession, path: str, token: str) -> DataFrame:
    """(key, field) of the documents that hold a token: one bucket is read."""
    about = _about(spark, path)
    schema = T.StructType.fromJson(json.loads(about.terms))
    terms = spark.read.schema(schema).parquet(f"{path}/terms")
    return terms.where((F.col("term_bucket") == _bucket(F.lit(token), about.buckets)) & (F.col("term") == token)).select("key", "field")


def search_index(spark: SparkSession, path: str, term: str) -> DataFrame:
    """The documents that ``search`` finds for the term, through the index. A term without
    letters or digits is in no index: it is searched for in all documents."""
    about = _about(spark, path)
    schema = T.StructType.fromJson(json.loads(about.docs)).add("key_bucket", "integer")
    docs = spark.read.schema(schema).parquet(f"{path}/docs")
    key = F.col(f"`{about.key}`")
    tokens = tokens_of_term(term)
    if not tokens:
        return search(docs, term, about.searched).select(*[F.col(f"`{c}`") for c in about.columns])
    found = term_hits(spark, path, tokens[0]).select("key").distinct()
    for token in tokens[1:]:
        found = found.join(term_hits(spark, path, token).select("key"), "key", "left_semi")
    found = found.select(F.col("key").alias("found_key"), _bucket(F.col("key"), about.buckets).alias("found_bucket"))
    near = docs.join(found, (F.col("key_bucket") == F.col("found_bucket")) & key.eqNullSafe(F.col("found_key")), "left_semi")
    return near.where(any_field_matches(docs, term, about.searched)).select(*[F.col(f"`{c}`") for c in about.columns])


def term_counts(spark: SparkSession, path: str) -> DataFrame:
    """Documents per term and field, from the index alone."""
    about = _about(spark, path)
    terms = spark.read.schema(T.StructType.fromJson(json.loads(about.terms))).parquet(f"{path}/terms")
    return terms.groupBy("term", "field").agg(F.count("*").alias("n"))
