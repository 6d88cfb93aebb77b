"""How filters overlap: for every order of them, what each step removes.

Sorted posting lists. The documents are range-partitioned by id; in a range of ids, each
part (a value of one column) has for every filter the ascending list of the places that
fail it. Merging one filter's list into the union of others by galloping search gives
their union, and as its difference the documents which only this filter removes after
those. The 80 differences (a filter against each set of others) and their sizes are all
that any order needs: sizes add up over ranges, and every order of the filters is read
off the sums.

Documents that share an id, a part and the filters they fail are one entry with a
weight, counted before the entries are moved, so an id or a missing id that very
many rows have is no hot key. Whether an earlier document has the same text is found on two
64-bit hashes of it, spread over ``SALTS`` tasks a text.

A null text is empty, a null part the empty string. A document without an id is
nobody's earlier or later copy and has no label; rows that share an id are no copies of each other, and a
label holds if any label row of the id has it. Rows of any text length count alike. Columns other than those named
are not read, and an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroll.llm.common import shuffle_partitions, stage

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
#: Copies of one text go to this many tasks when they learn their first id.
SALTS = 16
#: Entries of an id range, and ids located by one galloping step.
RANGE, BLOCK = 1 << 16, 256
SIZES = ["n", "before", "fails", "only", "removed", "good", "toxic", "turns"]


def failures(docs: DataFrame, part: str = "lang") -> DataFrame:
    """Per document: part, doc_id, ``fails`` (bits of the filters A-D that it fails) and the
    text's two hashes. A: under 200 words; B: under half of the words are distinct; C: over
    3 % of the characters are A-Z; D: holds one of #$%&*|."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    rows = docs.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("words", words).select(
        "part", "doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"),
        F.size("words").alias("words"), F.size(F.array_distinct("words")).alias("distinct"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("capitals"), F.length("text").cast("long").alias("chars"), F.col("text").rlike(r"[#$%&*|]").alias("odd"),
    )
    tests = [F.col("words") < 200, 100 * F.col("distinct") < 50 * F.col("words"), 100 * F.col("capitals") > 3 * F.col("chars"), F.col("odd")]
    bits = sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))
    return rows.select("part", "doc_id", bits.alias("fails"), "h1", "h2")


def with_copies(rows: DataFrame) -> DataFrame:
    """Adds filter E: a document of a smaller id, in any part, has the same text."""
    first = rows.where("doc_id IS NOT NULL").groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    first = first.select("h1", "h2", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    copy = F.when(F.col("doc_id") > F.col("first"), SETS >> 1).otherwise(0)
    return salted.join(first, ["h1", "h2", "salt"], "left").select("part", "doc_id", F.col("fails").bitwiseOR(copy).alias("fails"))


def entries(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Weighted entries (doc_id, part, fails, n, good, toxic) in ascending order of ids, in ranges."""
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    weighted = rows.groupBy("doc_id", "part", "fails").agg(F.count("*").alias("n"))
    named = weighted.where("doc_id IS NOT NULL").join(marks, "doc_id", "left")
    mark = lambda c: F.when(F.col(c), F.col("n")).otherwise(F.lit(0).cast("long")).alias(c)
    both = named.select("doc_id", "part", "fails", "n", mark("good"), mark("toxic")).unionByName(
        weighted.where("doc_id IS NULL").select("doc_id", "part", "fails", "n", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    )
    order = ["doc_id", "part", "fails"]
    return both.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)


def gallop(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each of the ascending keys, the number of the ascending ids below it. Block by
    block of keys: steps that double from where the last block ended bracket the
    block's last key, a binary search within the bracket places all its keys."""
    at = np.empty(len(keys), dtype=np.int64)
    low = 0
    for i in range(0, len(keys), BLOCK):
        block = keys[i : i + BLOCK]
        step, high = 1, low
        while high < len(ids) and ids[high] < block[-1]:
            high += step
            step *= 2
        got = low + np.searchsorted(ids[low : high + 1], block)
        at[i : i + BLOCK] = got
        low = int(got[-1])
    return at


def merged(ids: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of two ascending lists, and what the second has beyond the first."""
    at = gallop(more, ids)
    known = np.zeros(len(more), dtype=bool)
    inside = at < len(ids)
    known[inside] = ids[at[inside]] == more[inside]
    return np.insert(ids, at[~known], more[~known]), more[~known]


def _orders_with(members: int) -> int:
    """Orders of all filters in which exactly a given set of ``members`` stands before a given filter."""
    return math.factorial(members) * math.factorial(len(FILTERS) - 1 - members)


def differences(fails: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of one part's entries in a range: for each (set, filter outside it) the SIZES;
    ``weights`` has columns n, good, toxic."""
    lists = [np.flatnonzero(fails >> f & 1) for f in range(len(FILTERS))]
    unions: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * SETS
    out = np.zeros((SETS, len(FILTERS), len(SIZES)), dtype=np.int64)
    out[:, :, 0] = weights[:, 0].sum()
    for s in range(SETS):
        if s:  # one list more than in an earlier union
            f = s.bit_length() - 1
            unions[s] = merged(unions[s ^ 1 << f], lists[f])[0]
        for f in range(len(FILTERS)):
            if not s >> f & 1:
                gone = weights[merged(unions[s], lists[f])[1]].sum(axis=0)
                out[s, f, 1] = weights[unions[s], 0].sum()
                out[s, f, 4:7] = gone
    for f in range(len(FILTERS)):
        out[:, f, 2] = out[0, f, 4]
        out[:, f, 3] = out[SETS - 1 ^ 1 << f, f, 4]
        out[:, f, 7] = sum(_orders_with(s.bit_count()) * out[s, f, 4] for s in range(SETS) if not s >> f & 1)
    return out


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    sums: dict[str, np.ndarray] = {}

    def settle() -> None:
        table = pa.Table.from_batches(held)
        parts, of = np.unique(np.array(table.column("part").to_pylist(), dtype=object), return_inverse=True)
        fails = table.column("fails").to_numpy()
        weights = np.stack([table.column(c).to_numpy() for c in ("n", "good", "toxic")], axis=1)
        for k, part in enumerate(parts):
            own = differences(fails[of == k], weights[of == k])
            sums[part] = sums[part] + own if part in sums else own
        held.clear()

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= RANGE:
            settle()
            if len(sums) > RANGE // SETS:  # very many parts: summed later
                yield _sizes(sums)
                sums.clear()
    if sum(b.num_rows for b in held):
        settle()
    if sums:
        yield _sizes(sums)


def _sizes(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
    pairs = [(s, f) for s in range(SETS) for f in range(len(FILTERS)) if not s >> f & 1]
    s, f = (np.array(x, dtype=np.int32) for x in zip(*pairs))
    block = np.concatenate([a[s, f] for a in sums.values()])
    part = [p for p in sums for _ in pairs]
    return pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.tile(s, len(sums))), pa.array(np.tile(f, len(sums))), *(pa.array(block[:, i]) for i in range(len(SIZES)))], names=["part", "earlier", "filter", *SIZES])


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Per part, earlier filters (``earlier``, bits) and next filter: the SIZES, that is documents of the
    part, removed by the earlier filters, failing this one, failing only this one, removed by it, of
    these labelled good and toxic, and its removals added up over all orders."""
    rows = stage(failures(docs, part), "audit-failures")
    sizes = entries(with_copies(rows), labels).mapInArrow(_audit, "part string, earlier int, filter int, " + ", ".join(f"{c} long" for c in SIZES))
    return sizes.groupBy("part", "earlier", "filter").agg(*[F.sum(c).alias(c) for c in SIZES])


def order_steps(sizes: DataFrame) -> DataFrame:
    """The audit laid out for every order of the filters: one row per part, order and step."""
    steps = []
    for order in itertools.permutations(range(len(FILTERS))):
        for i, f in enumerate(order):
            steps.append(("".join(FILTERS[x] for x in order), i + 1, sum(1 << x for x in order[:i]), f))
    places = sizes.sparkSession.createDataFrame(steps, "filter_order string, step int, earlier int, filter int")  # 600 rows
    return sizes.join(F.broadcast(places), ["earlier", "filter"]).select(
        "part", "filter_order", "step", (F.col("n") - F.col("before") - F.col("removed")).alias("kept"), "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"), F.col("only").alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), F.col("turns").alias("shapley"),
    )
