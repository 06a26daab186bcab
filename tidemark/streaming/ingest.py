"""Incremental ingestion of decoded events with Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.ledger import NATURAL_KEY


def final_only(stream: DataFrame, final_blocks: DataFrame) -> DataFrame:
    """Rows that can't be reorganized any more: up to the final block of their network (a small table: one row each)."""
    limits = final_blocks.select(F.col("network").alias("__n"), "final_block")
    return stream.join(F.broadcast(limits), stream["network"] == F.col("__n")).where("block_number <= final_block").drop("__n", "final_block")


def deduplicated(stream: DataFrame, keys: list[str] | None = None, delay: str = "1 day", ts: str = "block_timestamp") -> DataFrame:
    """One row for each natural key as long as repeats come within the delay of each other; state is dropped after it."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys or NATURAL_KEY)


def ingest(stream: DataFrame, target: str, checkpoint: str, partition: str | None = "block_date") -> StreamingQuery:
    """Writes what is new as Parquet and stops. Offsets and state live in the checkpoint: a second run adds nothing, and a
    run that failed goes on where it was, so no cursor column is needed."""
    rows = stream.withColumn("block_date", F.to_date("block_timestamp")) if partition == "block_date" else stream
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.partitionBy(partition) if partition else writer).start()


def scratch(spark: SparkSession) -> str:
    """A folder that all executors share: below spark.checkpoint.dir; elsewhere only where it is unset on a local master."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    at = at or f"/tmp/checkpoints/{spark.sparkContext.applicationId}"
    return f"{at.rstrip('/')}/stream-{uuid.uuid4().hex}"


def sample_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as an event stream with repeated keys, ingested twice; the second run finds nothing new."""
    at = scratch(spark)
    schema = spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema
    for _ in range(2):
        stream = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").option("maxFilesPerTrigger", 1).parquet(sf_dir)
        rows = stream.select(F.lit("celo").alias("network"), F.col("l_orderkey").cast("string").alias("tx_hash"), F.col("l_linenumber").alias("log_index"), F.col("l_shipdate").cast("timestamp").alias("block_timestamp"))
        ingest(deduplicated(rows, delay="3650 days"), f"{at}/events", f"{at}/state", partition=None).awaitTermination()
    return spark.read.parquet(f"{at}/events").select("network", "tx_hash", "log_index")
