"""Reproducible train/test splits.

Randomness is replaced by a seeded md5 order key so every split is exact,
repeatable on any cluster size, and expressible in SQL for the oracle.
Per-group ranks use ``ordering.rank_within`` (range-partitioned global rank),
so a stratum or a user holding a third of the rows is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.functions.columns import md5_order_key
from rankwell.operators.ordering import global_rank, rank_within

KEY = ["user_id", "item_id"]
# Arrival order of rating events: total because (user, item) is unique.
ARRIVAL = ["rated_at", "user_id", "item_id"]


def _quota(n: F.Column, fraction: float) -> F.Column:
    """floor(fraction * n + 0.5): the rounded share of a stratum."""
    return F.floor(F.lit(fraction) * n + F.lit(0.5))


def stratified_split(ratings: DataFrame, test_fraction: float = 0.2, seed: int = 42,
                     by: str = "rating", keys: list[str] = KEY) -> DataFrame:
    """Adds ``is_test``; in each stratum of ``by`` the first
    floor(f·n + 0.5) rows in md5('seed|user|item') order are test."""
    # The digest as bytes is in the order of its text at half the size.
    keyed = ratings.withColumn("__k", F.unhex(md5_order_key(seed, *keys)))
    ranked = rank_within(keyed, [by], ["__k", *keys], "__r", size="__n")
    return (ranked
            .withColumn("is_test", F.col("__r") <= _quota(F.col("__n"), test_fraction))
            .drop("__k", "__r", "__n"))


def train_test(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (split.filter(~F.col("is_test")).drop("is_test"),
            split.filter(F.col("is_test")).drop("is_test"))


def sample_fraction(df: DataFrame, fraction: float = 0.1, seed: int = 42, keys: list[str] = KEY) -> DataFrame:
    """Exactly floor(f·n + 0.5) rows, the first in md5 order (no replacement)."""
    keyed = df.withColumn("__k", md5_order_key(seed, *keys))
    ranked = global_rank(keyed, ["__k", *keys], "__r")
    n = ranked.agg(F.max("__r")).scalar()
    return ranked.filter(F.col("__r") <= _quota(n, fraction)).drop("__k", "__r")


def sample_n(df: DataFrame, n: int = 1000, seed: int = 42, keys: list[str] = KEY) -> DataFrame:
    """N rows without replacement (top-n of the md5 order; the limit is the feature)."""
    return (df.withColumn("__k", md5_order_key(seed, *keys))
            .orderBy("__k", *keys).limit(n).drop("__k"))


def kfold_assign(df: DataFrame, k: int = 5, order: list[str] | None = None) -> DataFrame:
    """Contiguous 1/k slices of the arrival order are the test folds.

    ``fold`` = floor((pos - 1) · k / n) with pos the 1-based arrival position."""
    order = order or ARRIVAL
    ranked = global_rank(df, order, "__pos")
    n = ranked.agg(F.max("__pos")).scalar()
    return ranked.withColumn("fold", F.floor((F.col("__pos") - 1) * k / n).cast("int")).drop("__pos")


def fold_sets(assigned: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """(base, test) for one fold; base = head slice ∪ tail slice."""
    head = assigned.filter(F.col("fold") < fold)
    tail = assigned.filter(F.col("fold") > fold)
    return head.unionByName(tail).drop("fold"), assigned.filter(F.col("fold") == fold).drop("fold")


def leave_n_out(df: DataFrame, start: int, stop: int, max_test: int = 0,
                order: list[str] | None = None) -> DataFrame:
    """Per user, the start-th … stop-th rating in arrival order is test,
    until ``max_test`` test rows have been handed out in arrival order
    (max_test <= 0: no global limit).  Adds ``is_test``."""
    order = order or ARRIVAL
    ranked = rank_within(df, ["user_id"], order, "__c")
    eligible = (F.col("__c") >= start) & (F.col("__c") <= stop)
    if max_test <= 0:
        return ranked.withColumn("is_test", eligible).drop("__c")
    el = global_rank(ranked.filter(eligible), order, "__e")
    keep = el.filter(F.col("__e") <= max_test).select(*KEY, F.lit(True).alias("is_test"))
    return (ranked.join(keep, KEY, "left")
            .withColumn("is_test", F.coalesce("is_test", F.lit(False))).drop("__c"))
