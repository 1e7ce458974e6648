"""SparkSession helper and lineage checkpoints."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Only applied when this helper starts the JVM (local runs and tests).
LOCAL_DEFAULTS = {"spark.driver.memory": "12g"}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "rankwell", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            for k, v in LOCAL_DEFAULTS.items():
                builder = builder.config(k, v)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is unset
    (local tests) fall back to a fresh scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="rankwell-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, schema: str | None = None) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and
    read it back.

    One job (``Dataset.checkpoint`` would compute the plan twice: once for the
    eager count and again when the RDD is written), the result survives
    executor loss, later plans start from files, and the file sizes give AQE
    real statistics for its join choices.  With a ``schema`` no job reads it from the files."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/rankwell-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    out = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    out._lineage_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete the table that ``cut_lineage`` wrote for ``df``; nothing that is still to be computed may need it."""
    path = getattr(df, "_lineage_path", None)
    if path:
        sc = df.sparkSession.sparkContext
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def sweep(spark: SparkSession) -> None:
    """Have the driver drop the plans that are done: only then does Spark delete their shuffle files on the executors."""
    spark.sparkContext._jvm.System.gc()
