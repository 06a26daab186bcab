"""Faucet impact. Traces: ts, sender, recipient, amount_g, success, call_type. Windows end at a timestamp, not a date."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import whole_days
from tidemark.plans.claims import USD, money

#: Calls that move no value of their own (fixed values).
INNER_CALLS = ["delegatecall", "staticcall"]


def outflows(traces: DataFrame, faucet: str, since: datetime | None = None) -> DataFrame:
    """Successful payments of the faucet; a call without a type counts."""
    rows = traces.where((F.col("sender") == faucet) & (F.col("amount_g") > 0) & F.col("success") & (~F.col("call_type").isin(INNER_CALLS) | F.col("call_type").isNull()))
    if since is not None:
        rows = rows.where(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    return rows.withColumn("day", F.to_date("ts"))


def valued(rows: DataFrame, prices: DataFrame, since: datetime | None = None) -> DataFrame:
    """Payments in US dollars; days without a price are worth 0. With `since`, prices of days that began before it don't
    count, as a day's price is stamped at its midnight."""
    p = prices.select("day", F.col("price").cast("decimal(12,4)").alias("price"))
    if since is not None:
        p = p.where(F.col("day").cast("timestamp_ntz") >= F.lit(since).cast("timestamp_ntz"))
    return rows.join(p, "day", "left").withColumn("usd", (money(F.col("amount_g")) * F.coalesce("price", F.lit(0).cast("decimal(12,4)"))).cast(USD))


def faucet_total(traces: DataFrame, prices: DataFrame, faucet: str) -> DataFrame:
    return valued(outflows(traces, faucet), prices).agg(
        F.count("*").alias("total_topups"), F.countDistinct("recipient").alias("unique_wallets"), F.sum("amount_g").cast("double").alias("total_distributed"), F.sum("usd").cast("double").alias("total_usd_value"),
        F.min("ts").alias("first_topup"), F.max("ts").alias("last_topup"), whole_days(F.max("ts"), F.min("ts")).alias("days_active"),
    )


def faucet_monthly(traces: DataFrame, prices: DataFrame, faucet: str, now: datetime) -> DataFrame:
    """Months that had ended."""
    month = F.trunc("day", "month")
    rows = valued(outflows(traces, faucet).where(F.col("ts") < F.lit(datetime(now.year, now.month, 1)).cast("timestamp_ntz")), prices)
    return rows.groupBy(month.alias("month")).agg(
        F.count("*").alias("topups"), F.countDistinct("recipient").alias("unique_wallets"), F.sum("amount_g").cast("double").alias("distributed"), F.sum("usd").cast("double").alias("usd_value"), (F.sum("amount_g").cast("double") / F.count("amount_g")).alias("avg_per_topup")
    )


def daily(traces: DataFrame, prices: DataFrame, faucet: str, now: datetime, days: int) -> DataFrame:
    since = now - timedelta(days=days)
    rows = valued(outflows(traces, faucet, since), prices, since)
    return rows.groupBy("day").agg(F.count("*").alias("topups"), F.countDistinct("recipient").alias("unique_wallets"), F.sum("amount_g").alias("distributed"), F.sum("usd").alias("usd_value"))


def faucet_daily(traces: DataFrame, prices: DataFrame, faucet: str, now: datetime, days: int = 90) -> DataFrame:
    return daily(traces, prices, faucet, now, days).withColumns({c: F.col(c).cast("double") for c in ("distributed", "usd_value")})


def faucet_runrate(traces: DataFrame, prices: DataFrame, faucet: str, now: datetime, days: int = 30) -> DataFrame:
    """Sums and means of daily figures. Summed daily wallets count a wallet once for every day."""
    mean = lambda c: F.sum(c).cast("double") / F.count(c)
    return daily(traces, prices, faucet, now, days).agg(
        F.count("*").alias("days_measured"), F.sum("topups").alias("total_topups_30d"), F.sum("unique_wallets").alias("total_unique_wallets_30d"), F.sum("distributed").cast("double").alias("total_30d"), F.sum("usd_value").cast("double").alias("total_usd_30d"),
        mean("topups").alias("avg_daily_topups"), mean("unique_wallets").alias("avg_daily_wallets"), mean("distributed").alias("avg_daily"), mean("usd_value").alias("avg_daily_usd"), (mean("usd_value") * 30).alias("projected_monthly_usd_cost"),
    )


def faucet_vs_claimers(traces: DataFrame, claims: DataFrame, faucet: str, contract: str, now: datetime, days: int = 30) -> DataFrame:
    since = now - timedelta(days=days)
    wallets = outflows(traces, faucet, since).select(F.col("recipient").alias("wallet")).distinct()
    claimers = claims.where((F.col("block_timestamp") >= F.lit(since).cast("timestamp_ntz")) & (F.col("contract_address") == contract)).select(F.col("claimer").alias("wallet"), F.lit(1).alias("claims")).distinct()
    n, also = F.count("*"), F.count("claims")
    return wallets.join(claimers, "wallet", "left").agg(n.alias("total_faucet_recipients"), also.alias("also_claimed"), F.round(F.try_divide(100.0 * also, n), 1).alias("pct_who_claim"), (n - also).alias("faucet_only_no_claim"))


def verified_users(whitelist: DataFrame, contract: str, now: datetime) -> DataFrame:
    """Whitelist: account, ts, contract_address."""
    recent = lambda days: F.countDistinct(F.when(F.col("ts") >= F.lit(now - timedelta(days=days)).cast("timestamp_ntz"), F.col("account")))
    return whitelist.where(F.col("contract_address") == contract).agg(F.countDistinct("account").alias("total_verified_users"), F.min("ts").alias("first_verification"), F.max("ts").alias("latest_verification"), recent(30).alias("new_last_30d"), recent(90).alias("new_last_90d"))


def activity_share(transactions: DataFrame, traces: DataFrame, claims: DataFrame, transfers: DataFrame, faucet: str, contract: str, now: datetime, days: int = 30) -> DataFrame:
    """The share of faucet, claim and transfer transactions in all of the chain's."""
    since = now - timedelta(days=days)
    recent = lambda c: F.col(c) >= F.lit(since).cast("timestamp_ntz")
    t = transactions.where(recent("ts") & F.col("success")).agg(F.count("*").alias("chain_transactions"))
    f = outflows(traces, faucet, since).agg(F.count("*").alias("faucet_txs"))
    c = claims.where(recent("block_timestamp") & (F.col("contract_address") == contract)).agg(F.count("*").alias("claim_txs"), F.countDistinct("claimer").alias("users"))
    x = transfers.where(recent("ts")).agg(F.count("*").alias("transfer_txs"))
    own = F.col("faucet_txs") + F.col("claim_txs") + F.col("transfer_txs")
    return t.crossJoin(f).crossJoin(c).crossJoin(x).select(
        "chain_transactions", "faucet_txs", "claim_txs", "transfer_txs", own.alias("own_txs"), F.round(F.try_divide(100.0 * own, F.col("chain_transactions")), 2).alias("pct_own"), F.round(F.try_divide(F.col("claim_txs") * 1.0, F.col("users")), 1).alias("avg_claims_per_user")
    )
