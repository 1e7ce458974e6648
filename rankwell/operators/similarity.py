"""Item-item cosine similarity above a threshold, pruned (M8).

The cosine of two items is taken over the users who rated both. Users are ordered by the number of their ratings, most first
(then by id), and an item's leading users are not indexed as long as the norm of that part of its vector stays below
the threshold. Two items whose common users all come no later than the end of the longer of their unindexed parts have a
cosine below the threshold, because that part alone has too small a norm; so only pairs that share an indexed
user in both are formed. Heavy users, whose ratings would pair everything with everything, are mostly unindexed.

The common users that are not indexed in both all lie in one of the two unindexed parts, so what they can add is bounded by the
larger of both parts' bounds: its norm times the other item's, or its sum times the other's largest rating. Pairs whose indexed
sum plus that bound stays below the threshold go; to the others the products of their unindexed users are added, and of no more.

Pairs are formed in rounds, each for a share of the first items, so that a round's shuffle has at most a few
pairs for each rating, however many pairs there are in all; its files go before the next round.

Dot products and squared norms are exact whole numbers for integer ratings.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankwell.session import cut_lineage, sweep

SLACK = 1e-9
#: Pairs of a round: so many for each indexed rating, and this many at least.
ROUND_PAIRS, LEAST_PAIRS = 2, 20_000_000


def _round_count(index: DataFrame) -> int:
    """In how many rounds the pairs of ``index`` are formed."""
    rated = index.groupBy("user_id").agg(F.count(F.lit(1)).cast("double").alias("n"))
    row = rated.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs"), F.sum("n").alias("cells")).first()
    return max(1, math.ceil((row["pairs"] or 0.0) / max(LEAST_PAIRS, ROUND_PAIRS * (row["cells"] or 0.0))))


def item_similarity(ratings: DataFrame, threshold: float, model_version: str = "v1") -> DataFrame:
    """M8: (item_id_1 < item_id_2, similarity_score, model_version) of all pairs with a cosine of at least ``threshold`` (> 0)."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie in (0, 1]")
    spark = ratings.sparkSession
    cells = ratings.select("user_id", "item_id", F.col("rating").cast("long").alias("rating")).filter("rating <> 0")
    heavy = cells.groupBy("user_id").agg(F.count(F.lit(1)).alias("rated"))
    # The window sees the ratings of one item; running sums do not keep them.
    of_item = Window.partitionBy("item_id")
    square = F.col("rating") * F.col("rating")
    cells = cells.join(heavy, "user_id").select(
        "user_id", "item_id", "rating", F.sum(square).over(of_item).alias("norm2"), F.max(F.abs("rating")).over(of_item).alias("top"),
        F.sum(square).over(of_item.orderBy(F.desc("rated"), "user_id").rowsBetween(Window.unboundedPreceding, 0)).alias("so_far"))
    indexed = F.sqrt(F.col("so_far") / F.col("norm2").cast("double")) >= threshold - SLACK
    # Of an item's unindexed part: the square of its norm, and the sum of its ratings.
    unindexed = ~F.col("indexed")
    cells = cut_lineage(cells.withColumn("indexed", indexed).select(
        "user_id", "item_id", "rating", "norm2", "top", "indexed",
        F.coalesce(F.max(F.when(unindexed, F.col("so_far"))).over(of_item), F.lit(0)).alias("part2"),
        F.coalesce(F.sum(F.when(unindexed, F.abs("rating"))).over(of_item), F.lit(0)).alias("part1")))
    index = cells.filter("indexed").drop("indexed")

    def side(i: int) -> DataFrame:
        return index.select("user_id", *[F.col(c).alias(f"{c}_{i}") for c in index.columns if c != "user_id"])

    def may_add(i: int, j: int) -> F.Column:
        """What the unindexed users of item i can add at most."""
        return F.least(F.sqrt(F.col(f"part2_{i}").cast("double") * F.col(f"norm2_{j}")), (F.col(f"part1_{i}") * F.col(f"top_{j}")).cast("double"))

    # What the indexed users of a pair must add up to; a whole number, because the sums are.
    size = F.sqrt(F.col("norm2_1").cast("double") * F.col("norm2_2"))
    least = F.ceil(size * F.lit(threshold - SLACK) - F.greatest(may_add(1, 2), may_add(2, 1)) - F.lit(1e-6)).cast("long")
    rounds, open_ = _round_count(index), None
    sweep(spark)
    for r in range(rounds):
        # Both sides are shuffled by user; adaptive execution splits a user who rated very many items.
        left = side(1).filter(F.pmod(F.xxhash64("item_id_1"), F.lit(rounds)) == r)
        met = left.join(side(2), "user_id").filter("item_id_1 < item_id_2").select(
            "item_id_1", "item_id_2", (F.col("rating_1") * F.col("rating_2")).alias("dot"), least.alias("least"))
        found = cut_lineage(met.groupBy("item_id_1", "item_id_2").agg(F.sum("dot").alias("dot"), F.max("least").alias("least")).filter("dot >= least").drop("least"))
        open_ = found if open_ is None else open_.unionByName(found)
        del left, met
        if rounds > 1:
            sweep(spark)
    # An unindexed user of the first item meets all ratings of the second; one of the second only what is indexed in the first, the rest is counted.
    part = cells.filter(unindexed)
    asked = [open_.select("item_id_1", "item_id_2").join(part.select(F.col("item_id").alias(f"item_id_{i}"), "user_id", F.col("rating").alias("mine")), f"item_id_{i}").select(
        "item_id_1", "item_id_2", F.col(f"item_id_{3 - i}").alias("item_id"), "user_id", "mine", F.lit(i == 1).alias("whole")) for i in (1, 2)]
    more = asked[0].unionByName(asked[1]).join(cells.select("item_id", "user_id", "rating", "indexed"), ["item_id", "user_id"]).filter("whole or indexed").select(
        "item_id_1", "item_id_2", (F.col("mine") * F.col("rating")).alias("dot"))
    dots = open_.unionByName(more).groupBy("item_id_1", "item_id_2").agg(F.sum("dot").alias("dot"))
    norms = cells.groupBy("item_id").agg(F.first("norm2").alias("norm2"))
    for i in (1, 2):
        dots = dots.join(norms.select(F.col("item_id").alias(f"item_id_{i}"), F.col("norm2").alias(f"norm2_{i}")), f"item_id_{i}")
    score = F.col("dot") / F.sqrt(F.col("norm2_1").cast("double") * F.col("norm2_2"))
    return dots.withColumn("score", score).filter(F.col("score") >= threshold).select(
        "item_id_1", "item_id_2", F.round("score", 6).alias("similarity_score"), F.lit(model_version).alias("model_version"))
