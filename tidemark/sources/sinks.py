"""Writes: partitioned raw tables, marts, appends of new keys, deletes, run health."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keyed import new_keys_only, without
from tidemark.sources.ledger import HEALTH

log = logging.getLogger("tidemark")


def write_events(df: DataFrame, path: str, cluster: list[str], mode: str = "append") -> None:
    """Raw events by day, rows of a file sorted by the cluster columns so that row groups can be skipped."""
    dated = df.withColumn("block_date", F.to_date("block_timestamp"))
    dated.repartition("block_date").sortWithinPartitions("block_date", *cluster).write.mode(mode).partitionBy("block_date").parquet(path)


def write_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def write_mart(df: DataFrame, table: str, partition: str | None = None, cluster: list[str] | None = None) -> None:
    """A full rebuild of a table."""
    rows = df.sortWithinPartitions(*cluster) if cluster else df
    writer = rows.write.mode("overwrite").format("parquet")
    (writer.partitionBy(partition) if partition else writer).saveAsTable(table)


def append_new(batch: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Appends the rows whose key isn't stored and returns them: a rerun adds nothing. The store is read once for its keys;
    what is appended is decided before the write begins."""
    spark = batch.sparkSession
    try:
        store = spark.read.schema(batch.schema).parquet(path)
        new = new_keys_only(batch, store, keys)
    except Exception as e:  # no table yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        new = batch.dropDuplicates(keys)
    new.write.mode("append").parquet(path)
    return new


def delete_keys(path: str, target: str, column: str, values: list[str], spark: SparkSession) -> None:
    """The table without the rows of some keys, as a new table."""
    without(spark.read.parquet(path), column, values).write.mode("overwrite").parquet(target)


def table_for(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table if it has the declared columns, else an empty one: an old layout is started anew."""
    empty = spark.createDataFrame([], schema)
    try:
        found = spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return empty
    return found if found.columns == empty.columns else empty


def deploy(spark: SparkSession, statements: dict[str, str]) -> list[str]:
    """Runs DDL in the order of names and stops at the first failure; returns what ran."""
    done = []
    for name in sorted(statements):
        spark.sql(statements[name])
        done.append(name)
    return done


def health_rows(spark: SparkSession, run_id: str, run_date: date, started: datetime, results: list[dict]) -> DataFrame:
    """One row for each metric of a run and a SUMMARY row: error before warn before ok."""
    base = {"run_id": run_id, "run_date": run_date, "started_at": started, "records_written": 0, "records_expected": 0, "details": "", "elapsed_ms": 0}
    rows = spark.createDataFrame([base | r for r in results], HEALTH)
    return with_summary(rows)


def with_summary(health: DataFrame) -> DataFrame:
    """Health rows and, for each run, one that sums them up."""
    bad, warn = F.count_if(F.col("status") == "error"), F.count_if(F.col("status") == "warn")
    one = health.groupBy("run_id", "run_date").agg(F.min("started_at").alias("started_at"), bad.alias("e"), warn.alias("w"), F.count("*").alias("n"), F.sum("records_written").alias("records_written"), F.sum("records_expected").alias("records_expected"), F.sum("elapsed_ms").alias("elapsed_ms"))
    status = F.when(F.col("e") > 0, "error").when(F.col("w") > 0, "warn").otherwise("ok")
    details = F.format_string("%d metrics, %d errors, %d warnings", "n", "e", "w")
    summary = one.select("run_id", "run_date", "started_at", F.lit("SUMMARY").alias("adapter"), F.lit("ALL").alias("chain"), F.lit("ALL").alias("metric_key"), status.alias("status"), "records_written", "records_expected", details.alias("details"), "elapsed_ms")
    return health.unionByName(summary)


def notify(send: Callable[[str], None], message: str) -> bool:
    """A side channel that never fails a run."""
    try:
        send(message)
        return True
    except Exception as e:
        log.warning("notification failed: %s", e)
        return False
