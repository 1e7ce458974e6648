"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwell.session import cut_lineage, release

__all__ = ["attach", "cut_lineage", "forget", "fresh", "map_batches", "read"]


def forget(spark, *tables: DataFrame) -> None:
    """Delete tables of ``cut_lineage`` that nothing needs any more, and have the driver drop the plans that are done: only then
    does Spark delete the shuffle files of these plans on the executors."""
    for table in tables:
        release(table)
    spark.sparkContext._jvm.System.gc()


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name based on ``name`` that ``df`` does not use (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn`` for each Arrow batch; the batches of a partition are independent."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def attach(df: DataFrame, table: DataFrame, key: str, rows_of_key: str, total: int, share: int = 1000) -> DataFrame:
    """``df`` left join ``table`` (unique ``key``) where a key may hold a large part of ``df``.

    ``table`` has the number of ``df`` rows of its key in ``rows_of_key``. Keys with more than
    ``total / share`` rows are at most ``share``, so their table rows are broadcast; all the other rows are
    joined by key, where no key is large. The column ``rows_of_key`` is dropped.
    """
    limit = max(1000, total // share)
    values = [c for c in table.columns if c not in (key, rows_of_key)]
    hot = table.filter(F.col(rows_of_key) > limit).select(
        F.col(key).alias("__hot"), F.struct(*values).alias("__hot_values"))
    cold = table.filter(F.col(rows_of_key) <= limit).select(
        F.col(key).alias("__cold"), F.pmod(rows_of_key, F.lit(1)).alias("__zero"), F.struct(*values).alias("__cold_values"))
    out = df.join(F.broadcast(hot), df[key] == F.col("__hot"), "left")
    # Rows that are done, and rows without a key, match nothing and must not meet in one task: they are dealt by a number
    # that no table row has (theirs is zero, computed so that it stays a join key).
    looking = F.col("__hot").isNull() & F.col(key).isNotNull()
    out = out.withColumn("__key", F.when(looking, F.col(key))).withColumn(
        "__spread", F.when(looking, 0).otherwise(1 + F.pmod(F.monotonically_increasing_id(), F.lit(65536))))
    out = out.join(cold, (F.col("__key") == F.col("__cold")) & (F.col("__spread") == F.col("__zero")), "left")
    picked: list[Column] = [F.coalesce(F.col(f"__hot_values.{v}"), F.col(f"__cold_values.{v}")).alias(v) for v in values]
    return out.select(*[F.col(c) for c in df.columns], *picked)
