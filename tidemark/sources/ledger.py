"""Declared schemas of the event tables, and typed readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMON = "network string, chain_id long, block_number long, block_hash string, block_timestamp timestamp_ntz, tx_hash string, tx_index long, tx_from string, tx_to string, tx_value string, tx_status long, tx_nonce long, log_index long, contract_address string, event_name string, ingested_at timestamp_ntz"
CLAIM_EVENTS = f"{COMMON}, claimer string, amount string"
INVITE_EVENTS = f"{COMMON}, inviter string, invitee string, bounty_paid string, inviter_level string, earned_level boolean"
FACTS = "date date, chain string, metric_key string, value double, source string, updated_at timestamp"
HEALTH = "run_id string, run_date date, started_at timestamp, adapter string, chain string, metric_key string, status string, records_written long, records_expected long, details string, elapsed_ms long"
RAW_INVITES = "date date, block_number long, block_timestamp timestamp_ntz, tx_hash string, log_index long, event string, inviter string, invitee string, invite_type string, inviter_paid_g double, invitee_paid_g double, campaign_returned_g double, total_paid_g double"
DAILY_ENTITY = "id string, activeUsers string, newClaimers string, totalClaims string, totalUBIDistributed string, quota string"

#: A log's key: no two rows of a table share it.
NATURAL_KEY = ["network", "tx_hash", "log_index"]
ZERO_ADDRESS = "0x0000000000000000000000000000000000000000"
#: Blocks behind the tip that may still change (fixed values).
FINALITY = {"xdc": 15, "celo": 64, "fuse": 20}


def read_events(spark: SparkSession, path: str, schema: str = CLAIM_EVENTS) -> DataFrame:
    """A raw event table by its declared schema: no inference, columns pruned by what a plan selects."""
    return spark.read.schema(schema).parquet(path)


def read_json_pages(spark: SparkSession, path: str, entity: str, schema: str = DAILY_ENTITY) -> DataFrame:
    """Entities of saved GraphQL responses, one JSON document a line: {"data": {entity: [...]}} or {"errors": [...]}.
    Responses with errors yield no rows."""
    payload = spark.read.text(path).select(F.from_json("value", f"data struct<{entity}: array<struct<{_nested(schema)}>>>, errors array<struct<message: string>>").alias("r"))
    return payload.where("r.errors is null").select(F.inline(F.col(f"r.data.{entity}")))


def _nested(schema: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (c.split() for c in schema.split(", ")))


def subgraph_daily(entities: DataFrame, field: str, decimals: int = 0, chain: str = "XDC") -> DataFrame:
    """A field of daily entities as (date, chain, value): ids are days since 1970, numbers are text; null fields go."""
    from tidemark.functions.amounts import scale_raw
    from tidemark.functions.dates import unix_day

    value = scale_raw(F.regexp_replace(F.col(field), ",", ""), decimals).cast("double")
    return entities.where(F.col(field).isNotNull()).select(unix_day(F.col("id")).alias("date"), F.lit(chain).alias("chain"), F.coalesce(value, F.lit(0.0)).alias("value"))


def raw_invites(df: DataFrame) -> DataFrame:
    """Typed projection of stored invite rows: addresses in lower case, amounts that aren't numbers as 0."""
    amount = lambda c: F.coalesce(F.nanvl(F.col(c).cast("string").try_cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c)
    amounts = [c for c in df.columns if c.endswith("_g")]
    return df.select(*[F.lower(c).alias(c) if c in ("inviter", "invitee", "tx_hash") else amount(c) if c in amounts else F.col(c) for c in df.columns])


def tip(heights: DataFrame, finality: dict[str, int] | None = None) -> DataFrame:
    """The last final block of each network."""
    margin = F.coalesce(*[F.when(F.col("network") == n, F.lit(m)) for n, m in (finality or FINALITY).items()], F.lit(0))
    return heights.groupBy("network").agg(F.max("block_number").alias("height")).select("network", F.greatest(F.lit(0).cast("long"), F.col("height") - margin).alias("final_block"))


def cursor(stored: DataFrame) -> DataFrame:
    """Where ingestion goes on: the last stored block of each network, which is read again and deduplicated, since a
    crash may have stored it in part."""
    return stored.groupBy("network").agg(F.max("block_number").alias("from_block"))
