"""N-gram Jaccard self-join by T-occurrence search (DivideSkip).

Documents link when the Jaccard similarity of their sets of word shingles is at
least ``percent`` / 100. Every link between different sets is found; the result
gives components and the number of links of each row, so copies are never
expanded into pairs.

1. *Sets.* Equal sets share a 64-bit set id; only one set per id goes on.
2. *Document frequencies.* Each distinct shingle of each set is shuffled once,
   in packed binary blocks by shingle range. A shingle of one set only can
   match nothing and stays behind.
3. *Survivors.* A set of n shingles needs T = ceil(percent * n / 100) matches,
   so a set with fewer shared shingles than T links with nothing (exact). Of a
   survivor's shared shingles, rarest first, two linked sets must meet within
   the first shared - T + 1: those prefixes alone form the candidate clusters.
4. *Search.* A cluster's sets go to tasks in blocks of ``block`` sets (every
   block meets every other one of its cluster, so a cluster of any size is split
   into tasks of bounded size). A task builds inverted lists over one block and
   searches each set of the other: the longest lists are set aside, the short
   ones merged by counting occurrences, and sets that reach the remaining need
   are probed by binary search in the long lists. A task counts the links of each
   of its sets, weighted by the rows of the other set, and returns the counts and a
   spanning forest of the links; links inside one forest tree tell the components
   nothing new. Two sets meet in one cell only, so the counts of all cells add up.

Null or empty texts and texts without words have an empty set and link with
nothing. Repeated rows are copies. Columns other than the two are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from docroll.llm.common import GOLDEN, chunks, components, doc_key, release, long_column, mix, shingle_hashes, shuffle_partitions, stage, text_buffer, text_key

WIDTH = 5
PERCENT = 75
#: Sets in one block of a cluster's search.
BLOCK = 500
#: First characters of a text that tell rows of equal shingles apart.
HEAD = 64
#: Lists longer than this many times the median are set aside for probing.
LONG_FACTOR = 4
#: Slices of its range that a task works on one after another, and shingles that
#: a task packs at once.
SLICES = 8
PACKED = 1 << 19


def need(n: np.ndarray | int, percent: int):
    """The least overlap of a set of n with any set it links with."""
    return -(-n * percent // 100)


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """By chunk: first row, distinct shingles sorted within each row, set sizes, set ids (0: empty)."""
    data, bounds = text_buffer(batch.column("text"))
    for i, j in chunks(bounds):
        part = bounds[i : j + 1]
        h, row = shingle_hashes(data[part[0] : part[-1]], part - part[0], width)
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        if len(h):
            first = np.ones(len(h), dtype=bool)
            first[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            h, row = h[first], row[first]
        n = np.bincount(row, minlength=j - i)
        total = np.zeros(j - i, dtype=np.uint64)
        np.add.at(total, row, mix(h))
        again = np.zeros(j - i, dtype=np.uint64)
        np.bitwise_xor.at(again, row, h * np.uint64(GOLDEN))
        sid = mix(total + mix(again) + n.astype(np.uint64)).view(np.int64)
        sid[n == 0] = 0
        yield i, h, n, sid


def _ids(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(n, sid) for _, _, n, sid in _sets(batch, width)]
            if got:
                n, sid = (np.concatenate(x) for x in zip(*got))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_key", "text_key", "head")), pa.array(n.astype(np.int64)), pa.array(sid)], names=["doc_key", "text_key", "head", "n_shingles", "sid"])
            release()

    return run


def _blobs(names: list[str], parts: np.ndarray, columns: list[np.ndarray], n: int) -> pa.RecordBatch:
    """One row per part: the values of each column that belong to it, packed.
    ``parts`` is ascending."""
    cut = np.searchsorted(parts, np.arange(n + 1))
    full = np.flatnonzero(np.diff(cut))
    packed = [pa.array([c[cut[p] : cut[p + 1]].tobytes() for p in full], pa.binary()) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), *packed], names=["part", *names])


def _part_of(x: np.ndarray, parts: int) -> np.ndarray:
    """The part of a 64-bit value: parts are equal ranges of values."""
    return ((x >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _unpack(batches: Iterator[pa.RecordBatch], kinds: dict[str, type]) -> list[list[np.ndarray]]:
    """By column, the arrays of all rows of a task, without copies."""
    rows = [batch for batch in batches if batch.num_rows]
    return [[np.frombuffer(x.as_buffer(), kind) for batch in rows for x in batch.column(name)] for name, kind in kinds.items()]


def _shingle_blocks(width: int, parts: int):
    def pack(got: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        tokens, n, sid = (np.concatenate(x) for x in zip(*got))
        owner = np.repeat(np.arange(len(n), dtype=np.uint32), n)
        order = np.argsort(tokens)
        tokens, owner = tokens[order], owner[order]
        out = _blobs(["tokens", "owner"], _part_of(tokens, parts), [tokens, owner], parts)
        table = np.stack([sid, n.astype(np.int64)]).tobytes()
        return pa.RecordBatch.from_arrays([*out.columns, pa.array([table] * len(out), pa.binary())], names=["part", "tokens", "owner", "sets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # sets that this task has sent already
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            for _, h, n, sid in _sets(batch, width):
                if len(seen) > 1_000_000:
                    seen.clear()
                new = np.zeros(len(n), dtype=bool)
                for k, s in enumerate(sid.tolist()):
                    if s and s not in seen:
                        seen.add(s)
                        new[k] = True
                if new.any():
                    held.append((h[np.repeat(new, n)], n[new], sid[new]))
                    size += len(held[-1][0])
                if size >= PACKED:
                    yield pack(held)
                    held, size = [], 0
                    release()
        if held:
            yield pack(held)

    return run


def _frequencies(tokens: np.ndarray, sid: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Shingles of two sets or more, with set, set size and document frequency."""
    order = np.argsort(tokens, kind="stable")
    t = tokens[order]
    same = t[1:] == t[:-1]
    more = np.zeros(len(t), dtype=bool)  # most occur once and go before the full sort
    more[1:] |= same
    more[:-1] |= same
    order = order[more]
    tokens, sid, size = tokens[order], sid[order], size[order]
    order = np.lexsort((sid, tokens))
    tokens, sid, size = tokens[order], sid[order], size[order]
    new = np.ones(len(tokens), dtype=bool)  # one set may have come from several tasks
    new[1:] = (tokens[1:] != tokens[:-1]) | (sid[1:] != sid[:-1])
    tokens, sid, size = tokens[new], sid[new], size[new]
    _, of, df = np.unique(tokens, return_inverse=True, return_counts=True)
    df = df[of] if len(of) else np.zeros(0, np.int64)
    keep = df > 1
    return tokens[keep], sid[keep], size[keep], df[keep]


def _shared(parts: int):
    """Document frequencies of a range of shingles; those of two sets or more go on, by set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = list(zip(*_unpack(batches, {"tokens": np.uint64, "owner": np.uint32, "sets": np.int64})))
        if not blocks:
            return
        lowest, highest = int(min(t[0] for t, _, _ in blocks)), int(max(t[-1] for t, _, _ in blocks))
        edges = np.array([lowest + (highest - lowest) * i // SLICES for i in range(1, SLICES)], dtype=np.uint64)
        cuts = [np.concatenate([[0], np.searchsorted(t, edges), [len(t)]]) for t, _, _ in blocks]
        kept = []
        for i in range(SLICES):
            tokens = np.concatenate([t[c[i] : c[i + 1]] for (t, _, _), c in zip(blocks, cuts)])
            sid = np.concatenate([s.reshape(2, -1)[0][o[c[i] : c[i + 1]]] for (_, o, s), c in zip(blocks, cuts)])
            size = np.concatenate([s.reshape(2, -1)[1][o[c[i] : c[i + 1]]] for (_, o, s), c in zip(blocks, cuts)])
            kept.append(_frequencies(tokens, sid, size))
            release()
        tokens, sid, size, df = (np.concatenate(x) for x in zip(*kept))
        if len(tokens):
            order = np.argsort(sid.view(np.uint64), kind="stable")
            tokens, sid, size, df = tokens[order], sid[order], size[order], df[order]
            yield _blobs(["sid", "n", "tokens", "df"], _part_of(sid.view(np.uint64), parts), [sid, size.astype(np.int32), tokens, df.astype(np.int64)], parts)

    return run


def _survivors(percent: int):
    """Sets whose shared shingles reach their need: shared shingles (sorted) and the prefix of the rarest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _unpack(batches, {"sid": np.int64, "n": np.int32, "tokens": np.uint64, "df": np.int64})
        if not got[0]:
            return
        sid, n, tokens, df = (np.concatenate(x) for x in got)
        # a set with too few shared shingles links with nothing
        _, of, count = np.unique(sid, return_inverse=True, return_counts=True)
        enough = count[of] >= need(n.astype(np.int64), percent)
        sid, n, tokens, df = sid[enough], n[enough], tokens[enough], df[enough]
        if not len(sid):
            return
        order = np.lexsort((tokens, df, sid))
        sid, n, tokens = sid[order], n[order].astype(np.int64), tokens[order]
        begin = np.flatnonzero(np.concatenate([[True], sid[1:] != sid[:-1]]))
        count = np.diff(np.append(begin, len(sid)))
        lack = count - need(n[begin], percent)
        release()
        for i in range(0, len(begin), 1000):
            out = [(sid[b], n[b], np.sort(tokens[b : b + c]).tobytes(), tokens[b : b + d + 1].view(np.int64)) for b, c, d in zip(begin[i : i + 1000], count[i : i + 1000], lack[i : i + 1000])]
            s, m, shared, prefix = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.int64()), pa.array(m, pa.int64()), pa.array(shared, pa.binary()), pa.array(prefix, pa.list_(pa.int64()))], names=["sid", "n", "shared", "prefix"])

    return run


def divide_skip(index: list[np.ndarray], index_n: np.ndarray, queries: list[np.ndarray], query_n: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each query the index rows that link with it. Sets are sorted arrays
    of shingles; ``*_n`` are the sizes of the whole sets (shingles that occur in
    one set only may be left out of the arrays)."""
    lens = np.array([len(x) for x in index])
    if not lens.sum():
        return
    tokens = np.concatenate(index)
    owner = np.repeat(np.arange(len(index)), lens)
    order = np.argsort(tokens, kind="stable")  # lists are ascending by owner
    tokens, owner = tokens[order], owner[order]
    keys, begin, size = np.unique(tokens, return_index=True, return_counts=True)
    for q, own in enumerate(queries):
        at = np.searchsorted(keys, own)
        at = at[keys[np.minimum(at, len(keys) - 1)] == own]  # a shingle that the index lacks has no list
        least = need(int(query_n[q]), percent)  # any partner shares at least this many
        if len(at) < least:
            continue
        at = at[np.argsort(size[at], kind="stable")]
        aside = min(least - 1, int((size[at] > LONG_FACTOR * max(1, np.median(size[at]))).sum()) + (len(at) - 1) // 2)
        short, long = at[: len(at) - aside], at[len(at) - aside :]
        merged = np.concatenate([owner[begin[k] : begin[k] + size[k]] for k in short])
        count = np.bincount(merged, minlength=len(index))
        found = np.flatnonzero(count >= least - aside)
        # partners' sizes bound the overlap that a link needs: 100 o >= p (n + m - o)
        wants = -(-percent * (query_n[q] + index_n[found]) // (100 + percent))
        o = count[found]
        for left, k in zip(range(len(long), 0, -1), long):
            alive = o + left >= wants
            found, wants, o = found[alive], wants[alive], o[alive]
            if not len(found):
                break
            members = owner[begin[k] : begin[k] + size[k]]
            p = np.searchsorted(members, found)
            o = o + (members[np.minimum(p, len(members) - 1)] == found)
        yield q, found[o >= wants]


def _find(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = int(parent[x])
    return x


def _search(percent: int):
    """Links within one cell (a pair of blocks of a cluster): a spanning forest
    (a, b) and, with a null b, the number of rows that each set a links with."""

    def run(table):  # no annotations: Spark would have to resolve them
        table = table.sort_by("sid")
        sid, n, rows, side = (table.column(c).to_numpy() for c in ("sid", "n", "rows", "side"))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shared")]
        _, first, at = np.unique(sid, return_index=True, return_inverse=True)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        parent = np.arange(len(first))
        links: list[tuple[int, int]] = []
        count = np.zeros(len(first), dtype=np.int64)
        for q, found in divide_skip([sets[i] for i in left], n[left], [sets[i] for i in right], n[right], percent):
            a = int(at[right[q]])
            others = left[found]
            others = others[at[others] != a]
            count[a] += rows[others].sum()
            apart = others[side[others] != 2]  # within a block, each set is searched itself
            count[at[apart]] += rows[right[q]]
            for b in at[others].tolist():
                ra, rb = _find(parent, a), _find(parent, b)
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
                    links.append((int(sid[first[a]]), int(sid[first[b]])))
        has = np.flatnonzero(count)
        release()
        return pa.table({
            "a": pa.array([*(x for x, _ in links), *sid[first[has]].tolist()], pa.int64()),
            "b": pa.array([*(y for _, y in links), *[None] * len(has)], pa.int64()),
            "n_links": pa.array([*[0] * len(links), *count[has].tolist()], pa.int64()),
        })

    return run


def set_links(docs: DataFrame, rows: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """Spanning links (a, b, 0) between set ids of the texts of ``docs``, and rows
    (a, null, n_links) whose sum for each a is the number of rows of other sets
    that it links with. ``rows``: (sid, rows) of all sets."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    shared = (
        texts.mapInArrow(_shingle_blocks(width, parts), "part int, tokens binary, owner binary, sets binary")
        .repartitionById(parts, "part")
        .mapInArrow(_shared(parts), "part int, sid binary, n binary, tokens binary, df binary")
        .repartitionById(parts, "part")
    )
    kept = stage(shared.mapInArrow(_survivors(percent), "sid long, n long, shared binary, prefix array<long>"), "jaccard-survivors")
    # sets that meet in a prefix shingle belong to one candidate cluster
    prefix = stage(kept.select("sid", F.explode("prefix").alias("token")), "jaccard-prefix")
    first = prefix.groupBy("token").agg(F.min("sid").alias("a"), F.count("*").alias("c")).where("c > 1")
    clusters = components(prefix.join(first, "token").where("a <> sid").select("a", F.col("sid").alias("b")).distinct(), "jaccard-clusters")
    # a cluster's sets are dealt to blocks; block i meets block j in cell (i, j)
    size = clusters.groupBy("root").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    weighed = clusters.withColumnRenamed("node", "sid").join(rows, "sid").join(size, "root")
    cells = F.expr("transform(sequence(0, blocks - 1), j -> struct(least(mine, j) AS i, greatest(mine, j) AS j, CASE WHEN mine = j THEN 2 WHEN mine < j THEN 0 ELSE 1 END AS side))")
    dealt = (
        kept.select("sid", "n", "shared").join(weighed, "sid")
        .withColumn("mine", mine).withColumn("cell", F.explode(cells))
        .select("root", "cell.i", "cell.j", "cell.side", "sid", "n", "rows", "shared")
    )
    return dealt.groupBy("root", "i", "j").applyInArrow(_search(percent), "a long, b long, n_links long")


def _groups(docs: DataFrame, width: int, percent: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(doc_key, text_key, head, n_shingles, sid) of every row, and of every set that is not empty
    (sid, least, rows, root, n_links): its smallest doc_key, its rows, its
    component, the rows of other sets that it links with."""
    text = F.col("text").cast("string")
    texts = docs.select(doc_key().alias("doc_key"), text_key().alias("text_key"), F.substring(text, 1, HEAD).alias("head"), text.alias("text"))
    ids = stage(texts.mapInArrow(_ids(width), "doc_key long, text_key long, head string, n_shingles long, sid long"), "jaccard-ids")
    sets = stage(ids.where("sid <> 0").groupBy("sid").agg(F.min("doc_key").alias("least"), F.count("*").alias("rows")), "jaccard-sets")
    # staged, so that no task runs two Python steps at once
    found = stage(set_links(texts, sets.select("sid", "rows"), width, percent, block), "jaccard-found")
    roots = components(found.where("b IS NOT NULL").select("a", "b"), "jaccard-links")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("sid")).agg(F.sum("n_links").alias("n_links"))
    group = sets.join(roots.withColumnRenamed("node", "sid"), "sid", "left").join(links, "sid", "left")
    group = group.select("sid", "least", "rows", F.coalesce("root", "sid").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return ids, stage(group, "jaccard-groups")


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_key (doc_id, a null as the smallest
    long), n_shingles, sid (set id, 0: empty set), component_id (the smallest
    doc_key reachable by links, itself included), copies (rows of the component),
    n_links (other rows it links with, those of an equal set included)."""
    ids, group = _groups(docs, width, percent, block)
    total = group.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("rows").alias("copies"))
    named = group.join(total, "root").select("sid", "component_id", "copies", (F.col("n_links") + F.col("rows") - 1).alias("n_links"))
    full = ids.where("sid <> 0").join(named, "sid").select("doc_key", "n_shingles", "sid", "component_id", "copies", "n_links")
    blank = ids.where("sid = 0").select("doc_key", "n_shingles", "sid", F.col("doc_key").alias("component_id"), F.lit(1).cast("long").alias("copies"), F.lit(0).cast("long").alias("n_links"))
    return full.unionByName(blank)


def one_per_component(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` (same columns) less near duplicates: of each
    component one row stays, of the smallest (doc_key, sid); of texts that share these,
    the least by its first characters, then its hash. Rows without words
    stay. Rows that share an id (or have none) but no component are different
    documents, and each component keeps its own."""
    ids, group = _groups(docs, width, percent, block)
    stays = group.groupBy("root").agg(F.min(F.struct(F.col("least").alias("doc_key"), "sid")).alias("stay")).select("stay.*")
    # the choice is made on keys; whole rows move once, to be matched with the keys that stay
    chosen = ids.join(stays, ["doc_key", "sid"]).groupBy("doc_key", "sid").agg(F.min(F.struct("head", "text_key")).alias("text"))
    chosen = chosen.select("doc_key", F.col("text.text_key").alias("text_key"))
    has_words = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, MapType)]
    rows = docs.where(has_words).select(doc_key().alias("doc_key"), text_key().alias("text_key"), F.xxhash64(*plain).alias("tie"), F.struct("*").alias("row"))
    turn = F.row_number().over(Window.partitionBy("doc_key", "text_key").orderBy("tie"))
    first = rows.withColumn("turn", turn).where("turn = 1")
    return first.join(chosen, ["doc_key", "text_key"], "left_semi").select("row.*").union(docs.where(~has_words))
