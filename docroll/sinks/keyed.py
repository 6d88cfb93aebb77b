"""A written set of documents with keys: merges of new documents, published at once.

Documents lie in buckets by the hash of their key. A merge reads and rewrites only the
buckets that its keys fall into, below a fresh folder, and then publishes one small
manifest that says where each bucket is now. Readers follow the last manifest, so a job
that is lost before that leaves the old set, whole; files that no manifest names any more go by
``vacuum``. Merges are one after another: two at a time with the same base, and the
second to publish fails.

Files below ``target``: ``manifests/<version>.json`` and ``data/<merge>/bucket=<b>/``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docroll.session import remove_path, stage

BUCKETS = 64


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def manifest(spark: SparkSession, target: str) -> dict | None:
    """The last published state of the set: version, keys, n_buckets, schema, buckets (bucket
    to folder) and batches; None before the first merge."""
    versions = [n for n in _children(spark, f"{target}/manifests") if n.endswith(".json")]
    if not versions:
        return None
    return json.loads(spark.read.text(f"{target}/manifests/{versions[-1]}", wholetext=True).first()[0])


def _publish(spark: SparkSession, target: str, state: dict) -> None:
    """Write beside, then rename: a manifest is there whole or not at all."""
    jvm = spark.sparkContext._jvm
    final = f"{target}/manifests/{state['version']:012d}.json"
    fs, where = _fs(spark, final)
    beside = jvm.org.apache.hadoop.fs.Path(f"{target}/manifests/.{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    if fs.exists(where) or not fs.rename(beside, where):
        fs.delete(beside, False)
        raise RuntimeError(f"version {state['version']} of {target} was published by another merge")


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, target: str, state: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(state["schema"]))
    wanted = [f for b, f in state["buckets"].items() if buckets is None or int(b) in buckets]
    paths = [f"{target}/data/{f}" for f in wanted]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_keyed(spark: SparkSession, target: str) -> DataFrame:
    """The set as the last manifest has it."""
    state = manifest(spark, target)
    if state is None:
        raise FileNotFoundError(f"no manifest below {target}")
    return _read(spark, target, state)


def merge_by_key(
    docs: DataFrame, target: str, keys: str | Sequence[str], order_by: Sequence[str] = (), combine: Sequence[Column] | None = None,
    buckets: int = BUCKETS, batch: str | None = None,
) -> dict:
    """Merge documents into the set below ``target`` (made by the first merge) and return the new manifest.

    Without ``combine`` a new document replaces that of its key; of new documents with one
    key the largest by ``order_by``, then by all columns, counts. With ``combine`` (aggregates, named like
    the other columns, that give the same columns again) old and new rows of a key are
    combined. ``batch`` names what is merged: a batch that the set has already is not merged again.
    A null key is a key."""
    spark = docs.sparkSession
    names = [keys] if isinstance(keys, str) else list(keys)
    old = manifest(spark, target)
    schema = old["schema"] if old else docs.schema.json()
    if old:
        if old["keys"] != names:
            raise ValueError(f"the set's keys are {old['keys']}")
        columns = T.StructType.fromJson(json.loads(schema))
        if {(f.name, f.dataType.simpleString()) for f in columns} != {(f.name, f.dataType.simpleString()) for f in docs.schema}:
            raise ValueError("the documents' columns differ from the set's")
        docs = docs.select(*[F.col(f"`{f.name}`") for f in columns])
        buckets = old["n_buckets"]
        if batch is not None and batch in old["batches"]:
            return old
    others = [c for c in docs.columns if c not in names]
    key = [F.col(f"`{k}`") for k in names]
    if combine is None:
        first = [c for c in order_by if c not in names]
        row = F.max(F.struct(*[F.col(f"`{c}`") for c in [*first, *[c for c in others if c not in first]]])).alias("row")
        new = docs.groupBy(*key).agg(row).select(*key, "row.*").select(*[F.col(f"`{c}`") for c in docs.columns])
    else:
        new = docs.groupBy(*key).agg(*combine).select(*[F.col(f"`{c}`") for c in docs.columns])
    new = stage(new, "keyed-new")
    touched = sorted(r[0] for r in new.select(_bucket(names, buckets).alias("b")).distinct().collect())  # at most ``buckets``
    state = {"version": 1, "keys": names, "n_buckets": buckets, "schema": schema, "buckets": {}, "batches": []} | (old or {})
    if touched:
        before = _read(spark, target, state, touched)
        if combine is None:
            same = [F.col(f"`{k}`").eqNullSafe(F.col(f"new_{i}")) for i, k in enumerate(names)]
            gone = new.select(*[k.alias(f"new_{i}") for i, k in enumerate(key)])
            merged = before.join(gone, same, "left_anti").unionByName(new)
        else:
            merged = before.unionByName(new).groupBy(*key).agg(*combine).select(*[F.col(f"`{c}`") for c in docs.columns])
        name = f"{state['version']:012d}-{uuid.uuid4().hex}"
        by = ["bucket", *names]
        placed = merged.withColumn("bucket", _bucket(names, buckets))
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        placed.repartitionByRange(n, *by).sortWithinPartitions(*by).write.partitionBy("bucket").parquet(f"{target}/data/{name}")
        state["buckets"] = state["buckets"] | {str(b): f"{name}/bucket={b}" for b in touched}
    state["version"] = old["version"] + 1 if old else 1
    state["batches"] = [*state["batches"], *([batch] if batch is not None else [])]
    _publish(spark, target, state)
    return state


def vacuum(spark: SparkSession, target: str) -> list[str]:
    """Delete data folders that the last manifest doesn't name; their names."""
    state = manifest(spark, target)
    kept = {f.split("/")[0] for f in state["buckets"].values()} if state else set()
    gone = [n for n in _children(spark, f"{target}/data") if n not in kept]
    for n in gone:
        remove_path(spark, f"{target}/data/{n}")
    return gone
