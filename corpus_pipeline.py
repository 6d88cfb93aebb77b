"""From raw documents to shards of training data, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which the
caller writes as Parquet and rereads as the next stage's ``docs``. All but the
last return the columns of ``docs``; extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docroll.llm import langid
from docroll.llm.common import stage
from docroll.llm.decontam import decontaminate
from docroll.llm.jaccard_join import one_per_component
from docroll.llm.mixing import mix
from docroll.llm.sample import held_out
from docroll.llm.sharding import shard_rows
from docroll.llm.ship import ship


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: a document whose language can't be told (no letters, or the
    best language scores less than ``langid.LEAST_SCORE``) goes. The network
    learns from the documents that carry a language, less the held-out fold."""
    ship(spark)  # each stage may be the first: sources and batch sizes for the workers
    return langid.accepted(docs, langid.fit(docs, ~held_out()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each component of near copies, one document stays."""
    ship(spark)
    return one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document that contains a benchmark passage goes."""
    ship(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its source's target asks for."""
    return mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with size, text_crc32, shard and slot."""
    ship(spark)
    return shard_rows(docs, carry=docs.columns)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("shards", shards),
]

#: SQL can express neither the network nor the components; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
