"""Experiment runs table.

A run is one row (experiment, run_name, params map<string,string>,
metrics map<string,double>, tags map<string,string>, ts, run_id) in a parquet
table.  ``run_id`` is a hash of all but the time, and the first write of a
run_id wins: a logging job that is run again after a failure adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankwell.sources.sinks import append, read_table, table_exists, write_unique

RUN_SCHEMA = ("experiment string, run_name string, params map<string,string>, "
              "metrics map<string,double>, tags map<string,string>")


def run_row(metrics_row: DataFrame, experiment: str, run_name: str, params: dict, tags: dict | None = None) -> DataFrame:
    """Turn a one-row metrics frame into a run row (metric columns become map entries)."""
    metric_cols = [c for c, t in metrics_row.dtypes if t in ("double", "float", "bigint", "int")]
    m = F.create_map(*[x for c in metric_cols for x in (F.lit(c), F.col(c).cast("double"))])
    p = F.create_map(*[x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))])
    t = F.create_map(*[x for k, v in (tags or {}).items() for x in (F.lit(k), F.lit(str(v)))])
    return metrics_row.select(F.lit(experiment).alias("experiment"), F.lit(run_name).alias("run_name"),
                              p.alias("params"), m.alias("metrics"), t.alias("tags"),
                              F.current_timestamp().cast("timestamp_ntz").alias("ts"))


def get_or_create_experiment(spark: SparkSession, root: str, name: str) -> str:
    """The id of the experiment ``name`` in the table ``root/experiments``, which gets a row when the name is new.

    The id is a hash of the name, so writers that create an experiment at the same time agree on it."""
    row = spark.range(1).select(F.lit(name).alias("name"), F.substring(F.sha2(F.lit(name), 256), 1, 16).alias("experiment_id"),
                                F.current_timestamp().cast("timestamp_ntz").alias("created"))
    path = f"{root.rstrip('/')}/experiments"
    write_unique(row, path, ["name"])
    return read_table(spark, path).filter(F.col("name") == name).select("experiment_id").first()[0]


def log_runs(runs: DataFrame, path: str) -> DataFrame:
    """Add the runs that the table at ``path`` does not have yet; returns them."""
    def entries(m):
        return F.array_sort(F.map_entries(m))
    same = F.sha2(F.to_json(F.struct("experiment", "run_name", entries("params").alias("params"), entries("metrics").alias("metrics"),
                                     entries("tags").alias("tags"))), 256)
    new = runs.withColumn("run_id", same).dropDuplicates(["run_id"])
    if table_exists(runs.sparkSession, path):
        new = new.join(read_table(runs.sparkSession, path).select("run_id"), "run_id", "left_anti").select(new.columns)
    return append(new, path)


def search_runs(spark: SparkSession, path: str, experiment: str, metric: str = "rmse") -> DataFrame:
    """Runs of an experiment ordered by a metric, runs without it last (0 is only what they display)."""
    runs = read_table(spark, path).filter(F.col("experiment") == experiment)
    return runs.orderBy(F.col("metrics")[metric].asc_nulls_last(), "run_name").withColumn(
        metric, F.coalesce(F.col("metrics")[metric], F.lit(0.0)))


def best_per_name(runs: DataFrame, metric: str = "rmse") -> DataFrame:
    """The best run of every run name: the smallest logged metric, runs without it last, then the newest."""
    w = Window.partitionBy("run_name").orderBy(F.col("metrics")[metric].asc_nulls_last(), F.col("ts").desc())
    return runs.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")
