"""Incremental rating ingestion with Structured Streaming.

New tab-separated rating files dropped into a landing folder are parsed and
appended to the ratings table with the same first-write-wins rule as the
batch loader: inside a micro-batch the earliest event per (user, item) wins,
and keys already stored are skipped.  The stream's checkpoint (in the shared
checkpoint folder) makes a restarted query resume where it stopped.  Each
micro-batch is one partition ``batch_id`` of the table, written with overwrite,
so a replayed batch replaces what it wrote before; the anti join reads the key
columns of the other batches only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.operators import quality
from rankwell.sources import rawfiles as RF
from rankwell.sources.sinks import table_exists

KEYS = ["user_id", "item_id"]


def _batch_writer(table_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = RF.parse_ratings(batch)
        good, _ = quality.check_ratings(parsed)
        existing = (spark.read.parquet(table_path).filter(F.col("batch_id") != batch_id)
                    if table_exists(spark, table_path) else good.limit(0))
        new = quality.insert_new(good, existing, KEYS, ["timestamp", "rating"])
        new.write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")
    return write


def start_ingest(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                 available_now: bool = True):
    """Start the ingestion query (``availableNow`` processes what is there and stops)."""
    lines = (spark.readStream.format("text").load(landing)
             .filter(F.length(F.trim("value")) > 0))
    writer = lines.writeStream.foreachBatch(_batch_writer(table_path)).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
