"""Exact global ranks without funnelling rows through one task.

``row_number() OVER (ORDER BY …)`` without a partition, or partitioned by a
hot key (one user, one rating value), sorts that whole group in a single task.
``global_rank`` gives the same numbers with a range-partitioned sort:

1. ``repartitionByRange(order)`` + ``sortWithinPartitions(order)`` — the
   order key must be total (unique), so the sampler splits even a hot prefix
   across partitions;
2. ``monotonically_increasing_id`` = (partition << 33) + index-in-partition;
3. the sorted, id-tagged frame is checkpointed into the shared checkpoint
   folder: range bounds come from sampling, which depends on shuffle-read
   order, so the frame is frozen once and both the per-partition counts and
   the rows are read from the same files (this also cuts the lineage, so a
   lost executor re-reads the checkpoint instead of re-sorting);
4. rows per partition -> running offsets (P rows, size bounded by P) ->
   broadcast back.

``rank_within`` ranks inside groups: a row's place in its partition's piece of the
group plus the group's rows in earlier partitions. Its join key is (partition,
group), so no key has more rows than a partition — never the group alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankwell.session import cut_lineage

LOW_BITS = 33


def _ranges(df: DataFrame, partitions: int | None, *order: str) -> DataFrame:
    """Sorted ranges of ``df``; without a number of them, adaptive execution joins neighbours that are small."""
    return df.repartitionByRange(*([partitions] if partitions else []), *order).sortWithinPartitions(*order)


def global_rank(df: DataFrame, order: list[str], out: str = "grank", partitions: int | None = None) -> DataFrame:
    """1-based rank of every row in the total order ``order`` (ascending)."""
    s = _ranges(df, partitions, *order).withColumn("__mid", F.monotonically_increasing_id())
    s = cut_lineage(s.withColumn("__part", F.shiftright("__mid", LOW_BITS)).withColumn(
        "__local", F.col("__mid").bitwiseAND(F.lit((1 << LOW_BITS) - 1))))
    sizes = s.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # P rows only: the running sum over partitions is tiny by construction.
    offsets = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__off"))
    return (s.join(F.broadcast(offsets), "__part")
            .withColumn(out, (F.col("__off") + F.col("__local") + 1).cast("bigint"))
            .drop("__mid", "__part", "__local", "__off"))


def rank_within(df: DataFrame, group: list[str], order: list[str], out: str = "rank",
                partitions: int | None = None, size: str | None = None) -> DataFrame:
    """1-based rank inside each ``group`` by ``order`` (order must make rows unique); ``size`` names a column for
    the number of rows of the group.

    No join on the group: rows are sorted by (group, order), so a partition is a sequence of group pieces, and a
    row's rank is its place in its piece plus the rows of the group in earlier partitions.  A group that spans
    partitions has one piece in each of them, so the pieces that need an offset are at most two per partition
    (2·P rows, broadcast); all other groups lie inside one partition, where a window counts them."""
    s = _ranges(df, partitions, *group, *order).withColumn("__mid", F.monotonically_increasing_id())
    s = cut_lineage(s.withColumn("__part", F.shiftright("__mid", LOW_BITS)))
    pieces = s.groupBy("__part", *group).agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__start"))
    # Groups with pieces in several partitions: their first and last piece border a partition's edge.
    edge = Window.partitionBy("__part")
    # Written once: three plans read the pieces, and where they are few their size lets the rows stay where they are in the last join.
    pieces = cut_lineage(pieces.withColumn("__edge", (F.col("__start") == F.min("__start").over(edge)) | (F.col("__start") == F.max("__start").over(edge))))
    whole = Window.partitionBy(*group)
    spread = (pieces.filter("__edge").withColumn("__pieces", F.count(F.lit(1)).over(whole)).filter("__pieces > 1")
              .withColumn("__before", F.sum("__n").over(whole.orderBy("__part")) - F.col("__n"))
              .withColumn("__size", F.sum("__n").over(whole)))
    keep = ["__part", *group, "__before", "__size"]
    # A null group is a group: keys compare null-safe, and the pieces' keys have names of their own.
    named = {g: f"__of_{i}" for i, g in enumerate(group)}

    def matched(one: DataFrame, two: DataFrame):
        out = one["__part"] == two["__at"]
        for g in group:
            out = out & one[g].eqNullSafe(two[named[g]])
        return out

    def renamed(df: DataFrame) -> DataFrame:
        return df.select(F.col("__part").alias("__at"), *[F.col(g).alias(named[g]) for g in group], *[c for c in df.columns if c not in ("__part", *group)])

    edges = renamed(spread.select("__part", *group))
    alone = pieces.join(F.broadcast(edges), matched(pieces, edges), "left_anti")
    known = spread.select(*keep, "__start").unionByName(alone.select("__part", *group, F.lit(0).cast("long").alias("__before"), F.col("__n").alias("__size"), "__start"))
    # (partition, group) is unique and its rows lie in one written partition: no group is larger than a partition here.
    known = renamed(known)
    out_df = s.join(known, matched(s, known)).drop("__at", *named.values())
    out_df = out_df.withColumn(out, (F.col("__mid") - F.col("__start") + 1 + F.col("__before")).cast("bigint"))
    if size:
        out_df = out_df.withColumn(size, F.col("__size"))
    return out_df.drop("__mid", "__part", "__before", "__size", "__start")


def exact_percentiles(df: DataFrame, col: str, ps: list[float], order_keys: list[str]) -> list[F.Column]:
    """Exact percentiles with linear interpolation (numpy 'linear' /
    ``percentile_cont``) as scalar-subquery Columns.

    Rank-based instead of Spark's ``percentile`` aggregate, whose buffer keeps
    every distinct value in the final task: the values are globally ranked once
    (range-partitioned), and only the two rows around each position (n − 1)·p
    are read back.  ``order_keys`` make the order total."""
    vals = df.select(F.col(col).cast("double").alias("__x"), *order_keys).filter(F.col("__x").isNotNull())
    ranked = global_rank(vals, ["__x", *order_keys], "__r")
    n = ranked.agg(F.max("__r")).scalar()
    out = []
    for p in ps:
        pos = (n - 1) * F.lit(float(p))
        near = ranked.filter((F.col("__r") == F.floor(pos) + 1) | (F.col("__r") == F.ceil(pos) + 1)).agg(
            F.min_by("__x", "__r").alias("lo"), F.max_by("__x", "__r").alias("hi"))
        out.append(near.select(F.col("lo") + (F.col("hi") - F.col("lo")) * (pos - F.floor(pos))).scalar())
    return out


def exact_percentile(df: DataFrame, col: str, p: float, order_keys: list[str]) -> F.Column:
    """One percentile of ``exact_percentiles``."""
    return exact_percentiles(df, col, [p], order_keys)[0]
