"""Mix sources to target weights by entropy balancing (DataFrame functions only).

Every source gets a target in words: the words of all sources shared by weight
(weights go round by the source's code-point order, a null source last), at most
``max_copies`` times what the source has, the excess reshared by weight.

A document of x words is taken r times. Of all rates with 0 <= r <= max_copies
that meet the token constraint sum(r * x) = target of a source, those nearest to
"each document once" in relative entropy are r = min(max_copies, exp(l * x)):
exponentially tilted, with one dual variable l per source. Safeguarded Newton
steps on the convex dual solve for l. Documents of one source and size share a
rate, so the steps run on the histogram (source, size, documents); each step is
one partial aggregation over it, and what the steps hold is a staged table.

Rates become whole copies without chance: cumulative rounding over the sizes of
a source (largest first), then the single sizes that best cancel what is left,
and within a size the extra copies go by a hash of the document. Reruns agree.

Null or empty texts and texts without words have size 0 and are taken once
(0 words). Repeated rows are separate rows. Other columns are not read by
``copies`` and are carried along by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docroll.llm.common import doc_key, drop_stage, stage

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
WORD = r"[^\x20\x09-\x0D]+"
TOLERANCE = 1e-9
#: Documents of one source and size that are ranked in one group.
RANKED = 10_000
#: Rounds that cancel what rounding to whole copies leaves of a source's target.
REPAIRS = 4


def word_count(text="text"):
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(histogram: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Per source: source_size, mean_size, least (smallest size above 0), target.

    The cap binds for sources with the least room per weight; with those in
    order, the share per weight of the others follows from running sums."""
    per = histogram.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"),
        (F.sum(F.col("size") * F.col("n")) / F.sum(F.when(F.col("size") > 0, F.col("n")))).alias("mean_size"),
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    room = F.lit(max_copies) * F.col("source_size")
    by_room = Window.orderBy(F.col("room") / F.col("w"), F.col("source").asc_nulls_last())
    before, everything = by_room.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    share = (F.sum("source_size").over(everything) - F.coalesce(F.sum("room").over(before), F.lit(0))) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    shares = per.withColumn("w", w).withColumn("room", room).withColumn("share", share)
    # the first source whose share fits sets the share of all that follow
    level = F.min(F.when(F.col("w") * F.col("share") <= F.col("room"), F.struct(F.col("room") / F.col("w"), "share"))).over(everything)
    fits = shares.withColumn("level", level["share"])
    return fits.select("source", "source_size", "mean_size", "least", F.coalesce(F.least(F.col("room").cast("double"), F.col("w") * F.col("level")), F.col("room").cast("double")).alias("target"))


def rate(dual, size, mean, max_copies: int = MAX_COPIES):
    return F.when(size == 0, F.lit(1.0)).otherwise(F.least(F.lit(float(max_copies)), F.exp(F.least(dual * size / mean, F.lit(50.0)))))


def solve_duals(histogram: DataFrame, targets: DataFrame, max_copies: int = MAX_COPIES, tolerance: float = TOLERANCE, steps: int = 60) -> DataFrame:
    """``targets`` with the dual variable of every source (0 where it has no words)."""
    ratio = F.col("target") / F.col("source_size")
    edge = F.col("mean_size") / F.col("least")  # 1 / the smallest scaled size
    at_most = F.log(F.lit(float(max_copies))) * edge
    duals = targets.withColumn("low", F.when(ratio < 1, F.log(ratio) * edge).otherwise(0.0)).withColumn("high", F.when(ratio < 1, 0.0).otherwise(at_most))
    full = ratio >= max_copies * (1 - 1e-12)
    now = stage(
        duals.withColumn("dual", F.when(full, F.col("high")).when(ratio > 0, F.log(ratio) / 4)).withColumn("off", F.lit(None).cast("double")),
        "mixing-duals",
    )
    cells = histogram.where("size > 0")
    for _ in range(steps):
        open_ = now.where(F.col("dual").isNotNull() & ~full)
        at = cells.join(open_.select(F.col("source").alias("s"), "dual", "mean_size"), F.col("source").eqNullSafe(F.col("s")))
        r = rate(F.col("dual"), F.col("size"), F.col("mean_size"), max_copies)
        mass = F.col("n") * F.col("size") * r
        slope = F.when(r < max_copies, mass * F.col("size") / F.col("mean_size")).otherwise(0.0)
        sums = at.groupBy("s").agg(F.sum(mass).alias("mass"), F.sum(slope).alias("slope"))
        joined = now.join(sums, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        over = F.col("mass") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("dual")), F.when(over, F.col("dual")).otherwise(F.col("high"))
        # Newton on log(mass) = log(target); a step out of the bracket becomes a bisection
        step = F.col("dual") - F.log(F.col("mass") / F.col("target")) * F.col("mass") / F.col("slope")
        safe = F.when((F.col("slope") > 0) & (step > low) & (step < high), step).otherwise((low + high) / 2)
        done = F.abs(F.col("mass") / F.col("target") - 1) <= tolerance
        moved = joined.select(
            *targets.columns,
            F.when(F.col("mass").isNull(), F.col("low")).otherwise(low).alias("low"),
            F.when(F.col("mass").isNull(), F.col("high")).otherwise(high).alias("high"),
            F.when(F.col("mass").isNull() | done, F.col("dual")).otherwise(safe).alias("dual"),
            F.abs(F.col("mass") / F.col("target") - 1).alias("off"),
        )
        after = stage(moved, "mixing-duals")
        drop_stage(now)
        now = after
        if (now.agg(F.max("off")).first()[0] or 0) <= tolerance:
            break
    return now.select(*targets.columns, F.coalesce("dual", F.lit(0.0)).alias("dual"))


def copies(docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Per row of ``docs``: doc_key, text_key (a hash of the text), source, size,
    source_size, target, copies (0 to max_copies)."""
    rows = docs.select(
        doc_key().alias("doc_key"), F.xxhash64(F.col("text").cast("string")).alias("text_key"), F.col("source").cast("string").alias("source"), word_count().alias("size")
    )
    rows = stage(rows, "mixing-rows")
    histogram = stage(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mixing-histogram")
    duals = solve_duals(histogram, stage(source_targets(histogram, weights, max_copies), "mixing-targets"), max_copies)
    cells = histogram.join(duals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    cells = cells.withColumn("rate", rate(F.col("dual"), F.col("size"), F.col("mean_size"), max_copies))
    down = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.round(F.sum(F.when(F.col("size") > 0, F.col("n") * F.col("rate")).otherwise(F.col("n"))).over(down))
    cells = cells.withColumn("upto", upto.cast("long"))
    k = F.col("upto") - F.coalesce(F.lag("upto").over(Window.partitionBy("source").orderBy(F.desc("size"))), F.lit(0))
    cells = cells.withColumn("k", F.least(F.greatest(k, F.lit(0)), F.col("n") * max_copies))
    columns = ["source", "size", "n", "source_size", "target", "k"]
    cells = cells.select(*columns)
    for _ in range(REPAIRS):
        left = cells.groupBy("source").agg((F.first("target") - F.sum(F.col("k") * F.col("size"))).alias("left")).withColumnRenamed("source", "s")
        able = cells.join(left, F.col("source").eqNullSafe(F.col("s"))).drop("s").where(F.when(F.col("left") > 0, F.col("k") < F.col("n") * max_copies).otherwise(F.col("k") > 0) & (F.col("size") > 0))
        gain = F.abs(F.col("left")) - F.abs(F.abs(F.col("left")) - F.col("size"))
        best = able.groupBy("source").agg(F.max(F.struct(gain.alias("gain"), "size", F.signum("left").cast("long").alias("by"))).alias("best")).where("best.gain > 0")
        best = best.select(F.col("source").alias("s"), F.col("best.size").alias("z"), F.col("best.by").alias("by"))
        after = stage(cells.join(best, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")), "left").withColumn("k", F.col("k") + F.coalesce("by", F.lit(0))).select(*columns), "mixing-cells")
        cells = after
    # within a size, the extra copies go by hash; large cells are ranked in groups
    cells = cells.withColumnsRenamed({"source": "s", "size": "z"})
    placed = rows.join(cells, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).drop("s", "z")
    order = F.xxhash64("doc_key", "text_key")
    placed = placed.withColumn("group", F.pmod(F.xxhash64(order, F.lit(1)), F.ceil(F.col("n") / RANKED))).withColumn("order", order)
    groups = placed.groupBy("source", "size", "group").agg(F.count("*").alias("m"))
    ahead = F.coalesce(F.sum("m").over(Window.partitionBy("source", "size").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = groups.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("group").alias("g"), ahead.alias("ahead"))
    placed = placed.join(groups, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("group") == F.col("g")))
    rank = F.col("ahead") + F.row_number().over(Window.partitionBy("source", "size", "group").orderBy("order", "doc_key", "text_key"))
    got = F.floor(F.col("k") / F.col("n")) + F.when(rank <= F.col("k") % F.col("n"), 1).otherwise(0)
    return placed.select("doc_key", "text_key", "source", "size", "source_size", "target", got.cast("int").alias("copies"))


def mix(docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """The rows of ``docs`` (same columns, whatever their names), each as many times as the
    mix takes it. Rows of one id, text and source share out their copies in the order of a
    hash of the whole row, so reruns agree and no words move to another source."""
    least = [f"least_{c}" for c in range(1, max_copies + 1)]
    times = copies(docs, weights, max_copies).groupBy(F.col("doc_key").alias("k"), F.col("text_key").alias("t"), F.col("source").alias("s")).agg(*[F.count(F.when(F.col("copies") >= c, 1)).alias(n) for c, n in enumerate(least, 1)])
    nested = (T.MapType, T.VariantType, T.ArrayType, T.StructType)
    whole = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{f.name}`"))) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in docs.schema.fields])
    keyed = docs.select(
        doc_key().alias("doc_key"), F.xxhash64(F.col("text").cast("string")).alias("text_key"), F.col("source").cast("string").alias("source"), whole.alias("whole"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    joined = keyed.join(times, (F.col("doc_key") == F.col("k")) & (F.col("text_key") == F.col("t")) & F.col("source").eqNullSafe(F.col("s"))).drop("k", "t", "s")
    turn = F.row_number().over(Window.partitionBy("doc_key", "text_key", "source").orderBy("whole"))
    taken = sum((F.when(F.col("turn") <= F.col(n), 1).otherwise(0) for n in least), F.lit(0))
    repeated = joined.withColumn("turn", turn).withColumn("times", taken).where("times > 0").withColumn("copy", F.explode(F.expr("sequence(1, times)")))
    return repeated.select("row.*")
