"""Connected components of links by union-find in rounds: large and small stars, as joins and aggregations."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Removes the shuffle files of every query that runs meanwhile at its end, not when the driver happens to collect
    its garbage. A frame that is run again shuffles again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later jobs start from files, not from its lineage, and what
    the write has shuffled is on no disk any more."""
    with _shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of its neighbourhood."""
    ways = _both_ways(links)
    least = ways.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return ways.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    others = links.join(least, "u").where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return others.union(least.select("u", F.col("least").alias("v"))).distinct()


def components(links: DataFrame, folder: str) -> DataFrame:
    """``id`` and ``component``, the least id that it reaches, of every id in ``links`` (``a``, ``b``) that is not
    itself the least. NULL ids and links to itself are left out; no links give no rows.

    A node with very many links is only a key of aggregations and of joins that adaptive execution can split.
    """
    now = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, before, turn = stored(now, f"{folder}/links"), None, 0
    while True:
        state = tuple(now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v") % (1 << 40)), F.lit(0))).first())
        if state == before or not state[0]:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before, turn = state, turn + 1
        now = stored(_small_star(_large_star(now)), f"{folder}/round-{turn}")


def linked_groups(shared: DataFrame, possible: str, verify: Callable[[DataFrame], DataFrame], folder: str, rounds: int, central: str = "0") -> DataFrame:
    """``id`` and ``label`` of every member that links with another one; members without a row stand alone.

    ``shared`` (``key``, ``id`` and what the SQL condition ``possible`` asks of its rows ``x`` and ``y``) says who
    could link: members with a common key. ``verify`` returns those of the pairs (``a``, ``b``) that do. In each
    of the first ``rounds``, the members of a key are held against one pivot unless they are in its component
    already, so a large group of members that link is linear work. The pivots of the first two rounds have the
    least value of ``central``, an SQL expression; those of later rounds are arbitrary. The last step lists all pairs of a key that are
    still in different components; no possible link is left out.
    """
    kept, labels, tried, turn = shared.columns, None, None, 0
    while True:
        if labels is None:  # nothing links yet, so rows stay where they are stored, those of a key together
            now = shared.select(*kept, F.col("id").alias("label"))
        else:
            now = shared.join(labels, "id", "left").select(*kept, F.coalesce("label", "id").alias("label"))
        row = F.struct(*[c for c in kept if c != "key"], "label")
        pivots = now.groupBy("key").agg(
            F.min(F.struct(F.expr(central if turn < 2 else "0").alias("rank"), F.xxhash64("id", F.lit(turn)).alias("order"), row.alias("row"))).alias("first"),
            F.min("label").alias("low"),
            F.max("label").alias("high"),
        )
        pivots = pivots.where("low < high").select("key", "first.row.*")
        if turn < rounds:
            against, apart = pivots, "x.label <> y.label"
        else:
            against, apart = now.join(pivots.select("key"), "key", "left_semi"), "x.label < y.label"
        found = now.alias("x").join(against.alias("y"), "key").where(f"{apart} and {possible}")
        pairs = found.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
        pairs = stored(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), f"{folder}/pairs-{turn}")
        if pairs.isEmpty():
            if turn >= rounds:
                return shared.sparkSession.createDataFrame([], "id long, label long") if labels is None else labels
            turn = rounds
            continue
        links = verify(pairs)
        if labels is None:
            labels = stored(components(links, f"{folder}/components-{turn}").withColumnRenamed("component", "label"), f"{folder}/labels-{turn}")
        else:
            for c in ("a", "b"):  # links join the components that their ends are in
                links = links.join(labels.select(F.col("id").alias(c), F.col("label").alias(f"label_{c}")), c, "left")
            links = links.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
            merged = components(links, f"{folder}/components-{turn}")
            moved = labels.join(merged.select(F.col("id").alias("label"), "component"), "label", "left").select("id", F.coalesce("component", "label").alias("label"))
            new = merged.join(labels, "id", "left_anti").select("id", F.col("component").alias("label"))
            labels = stored(moved.union(new), f"{folder}/labels-{turn}")
        if turn >= rounds:
            return labels
        tried = pairs if tried is None else tried.union(pairs)
        turn += 1
