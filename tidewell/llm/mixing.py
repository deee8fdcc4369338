"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a budget of words. Whole passes over a source come first; what then remains is fitted exactly:
documents are counted by exact length, each length gives its share, and a bounded-knapsack dynamic programme over the
documents left over fills the rest of the budget to the word, or as near to it as any choice of them comes. Which
documents of a length are taken follows from a seeded hash, so reruns agree.

Only counts per source and length meet in a task. Documents are dealt out by source, length and slice of the hash
space, so no length of any source, however frequent, is ranked in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.components import stored

#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: No document is taken more often.
MOST_PASSES = 3
#: Words of a budget that are left to the dynamic programme; more where the documents that remain are longer.
WINDOW = 1 << 15
#: Documents of one source and length that are ranked together, on average.
SLICE_ROWS = 512
#: Parts that the documents of one length are dealt to when they meet their plan.
SALTS = 16
#: Parts of the ordered list of sources.
RANGES = 32


def words(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))), F.lit(0))


def fill(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take, so that their words come as near to ``budget`` as possible.

    ``lengths`` are distinct and positive, ``budget`` is at most all words. All of a budget up to WINDOW words is left
    to the dynamic programme, so the result is the best there is. Of a larger one, every length first gives its
    share of what is above WINDOW, rounded down, then the longest give more until WINDOW words are missing. The
    programme keeps for every sum the length that reached it first: before that length, the sum without it was
    reached already, so the way back never takes more than there are.
    """
    taken = np.zeros(len(lengths), np.int64)
    total = int(np.dot(lengths, counts))
    if not total or budget <= 0:
        return taken
    above = max(0, budget - WINDOW)
    taken = np.array([int(c) * above // total for c in counts], np.int64)
    missing = budget - int(np.dot(lengths, taken))
    order = np.argsort(-lengths)
    for i in order:
        if missing <= WINDOW:
            break
        more = min(int(counts[i] - taken[i]), (missing - WINDOW) // int(lengths[i]))
        taken[i], missing = taken[i] + more, missing - more * int(lengths[i])
    left = counts - taken
    open_lengths = [int(i) for i in order if left[i] and lengths[i] <= 2 * missing]
    if not missing or not open_lengths:
        return taken
    limit = 2 * missing  # nothing at all is as near as that
    first = np.full(limit + 1, -1, np.int32)
    times = np.zeros(limit + 1, np.int64)
    reached, mask = 1, (1 << (limit + 1)) - 1
    for i in open_lengths:
        part, rest, length = 1, min(int(left[i]), limit // int(lengths[i])), int(lengths[i])
        while rest:  # powers of two and a remainder stand for any number up to ``rest``
            part = min(part, rest)
            new = (reached << (part * length)) & mask & ~reached
            if new:
                bits = np.unpackbits(np.frombuffer(new.to_bytes(limit // 8 + 1, "little"), np.uint8), bitorder="little")
                sums = np.flatnonzero(bits)
                first[sums], times[sums] = i, part
                reached |= new
            rest, part = rest - part, part * 2
        if (reached >> missing) & 1:
            break
    sums = np.flatnonzero(np.unpackbits(np.frombuffer(reached.to_bytes(limit // 8 + 1, "little"), np.uint8), bitorder="little"))
    at = int(sums[np.abs(sums - missing).argmin()])  # of two as near, the smaller
    while at:
        i, part = int(first[at]), int(times[at])
        taken[i], at = taken[i] + part, at - part * int(lengths[i])
    return taken


_PLAN = "source string, size long, docs long, source_size long, target double, passes long, extra long"


def _fitted(table: pa.Table) -> pa.Table:
    """The plan of one source from its counts per length."""
    table = table.sort_by("size")
    sizes, docs = table.column("size").to_numpy(), table.column("docs").to_numpy()
    total, target = int(table.column("source_size")[0].as_py()), float(table.column("target")[0].as_py())
    passes = min(MOST_PASSES, int(target // total)) if total else 0
    budget = min(max(round(target - passes * total), 0), total) if passes < MOST_PASSES else 0
    extra = np.zeros(len(sizes), np.int64)
    extra[sizes > 0] = fill(sizes[sizes > 0], docs[sizes > 0], budget)
    return pa.table({**{c: table.column(c) for c in ("source", "size", "docs", "source_size", "target")}, "passes": pa.array(np.full(len(sizes), passes)), "extra": pa.array(extra)})


def targets(per_source: DataFrame, folder: str) -> DataFrame:
    """``per_source`` (``source``, ``source_size``) with ``weight`` and ``target``.

    Sources stand by code point, NULL last, and get the weights in turn. The targets share all words by weight; one
    above three times its source's size stops there, and what is over is shared anew among the others until none is
    above. The list is ordered by range, and the driver sees one number per range and four per round.
    """
    spark = per_source.sparkSession
    order = (F.col("source").isNull(), F.col("source"))
    placed = per_source.repartitionByRange(RANGES, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = stored(placed, f"{folder}/sources")  # the number of the range is in the upper bits of ``at``, the place below
    place, part = F.col("at").bitwiseAND((1 << 33) - 1), F.shiftright("at", 33)
    starts, before = {}, 0
    for row in placed.groupBy(part.alias("part")).count().orderBy("part").collect():
        starts[row["part"]], before = before, before + row["count"]
    if not starts:
        return spark.createDataFrame([], "source string, source_size long, weight int, target double")
    start = F.create_map(*(F.lit(x) for pair in starts.items() for x in pair))[part]
    kind = (start + place) % len(WEIGHTS)
    weighted = placed.select("source", "source_size", F.array(*(F.lit(w) for w in WEIGHTS))[kind.cast("int")].alias("weight"))
    most = MOST_PASSES * F.col("source_size")
    stopped_before = None
    share, full = F.lit(0.0), F.lit(False)
    while True:
        sums = weighted.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, most).otherwise(0)).alias("stopped"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weights"), F.count_if(full).alias("n"),
        ).first()
        free, weights = sums["all"] - sums["stopped"], sums["weights"]
        if sums["n"] == stopped_before or not weights:
            return weighted.withColumn("target", F.when(full, most.cast("double")).otherwise(share))
        stopped_before = sums["n"]
        share = F.lit(float(free)) * F.col("weight") / F.lit(float(weights))
        full = full | (share > most)


def mix(docs: DataFrame, folder: str, seed: int = 1) -> DataFrame:
    """A row per row of ``docs``: ``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``taken``, the
    words that the mix takes of it, a multiple of its size and at most three times that.

    NULL and empty texts have size 0 and nothing is taken; a source without words has target 0. NULL sources are one
    source, the last. Rows that agree in all that the seed sees are told apart by nothing, and any of them may
    be taken. An empty table gives no rows; columns of other names are not looked at. ``folder`` must be shared by
    all executors.
    """
    text, seen = F.col("text").cast("string"), F.col("doc_id").cast("long")
    order = F.xxhash64(seen, F.xxhash64(text), F.lit(seed))
    sized = stored(docs.select(seen.alias("doc_id"), F.col("source").cast("string").alias("source"), words(text).cast("long").alias("size"), order.alias("order")), f"{folder}/sizes")

    counts = stored(sized.groupBy("source", "size").agg(F.count("*").alias("docs")), f"{folder}/counts")
    per_source = targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size")), folder)
    one = F.col("source").eqNullSafe(F.col("_source"))
    by_length = counts.join(per_source.withColumnRenamed("source", "_source"), one).select("source", "size", "docs", "source_size", "target")
    # one group holds a row per distinct length of a source: their number grows with the root of its words at most
    plan = stored(by_length.groupBy("source").applyInArrow(_fitted, _PLAN), f"{folder}/plan")

    salts = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnsRenamed({"source": "_source", "size": "_size"})
    same = one & (F.col("size") == F.col("_size")) & (F.pmod(F.xxhash64("order"), F.lit(SALTS)) == F.col("salt"))
    # sorted and merged: the size of the plan's files says little of what a broadcast would take
    planned = sized.join(salts.hint("merge"), same).drop("_source", "_size", "salt")
    slices = F.ceil(F.col("docs") / SLICE_ROWS)
    slice_of = F.floor((F.shiftrightunsigned("order", 11) / F.lit(float(1 << 53))) * slices).alias("slice")  # of equal width
    planned = planned.select("*", slice_of)
    in_slice = Window.partitionBy("source", "size", "slice").orderBy("order", "doc_id")
    ranked = planned.withColumn("place", F.row_number().over(in_slice))
    earlier = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    per_slice = planned.groupBy("source", "size", "slice").agg(F.count("*").alias("n"))
    before = per_slice.select(F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("slice").alias("_slice"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = ranked.join(before, one & (F.col("size") == F.col("_size")) & (F.col("slice") == F.col("_slice")))
    more = (F.col("before") + F.col("place") <= F.col("extra")).cast("long")
    return placed.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * (F.col("passes") + more)).alias("taken"))
