"""Claim dashboards: active claimers, new and returning claimers, the daily summary."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.series import date_spine, over_days, rolling_distinct

#: Claims have: claimer, contract_address, block_timestamp, amount_g (decimal(37,18)).
USD = "decimal(38,6)"


def money(amount: Column) -> Column:
    """Amounts before they are valued: with two decimals, products with a price of four are exact."""
    return amount.cast("decimal(22,2)")


def active_claimers(claims: DataFrame, contract: str, as_of: date, read_days: int = 119, show_days: int = 90) -> DataFrame:
    """dau, wau (7 days) and mau (30) of each day with claims, for the last show_days."""
    first, last = as_of - timedelta(days=read_days), as_of - timedelta(days=1)
    rows = claims.where((F.col("contract_address") == contract) & (F.col("block_timestamp") >= F.lit(first).cast("timestamp_ntz")) & (F.col("block_timestamp") < F.lit(as_of).cast("timestamp_ntz")))
    seen = rows.select(F.to_date("block_timestamp").alias("day"), "claimer").distinct()
    shown = as_of - timedelta(days=show_days)
    counts = [rolling_distinct(seen, "day", "claimer", n, name, shown, last) for n, name in ((1, "dau"), (7, "wau"), (30, "mau"))]
    return counts[0].join(counts[1], "day").join(counts[2], "day")


def daily_claimers(claims: DataFrame, contract: str, as_of: date, days: int) -> DataFrame:
    """Unique, new and returning claimers of each day. First days come from the contract's claims alone, activity from all
    contracts of these claimers; earlier activity elsewhere counts as returning."""
    first = claims.where(F.col("contract_address") == contract).groupBy("claimer").agg(F.to_date(F.min("block_timestamp")).alias("first_day"))
    since = as_of - timedelta(days=days)
    active = claims.where((F.col("block_timestamp") >= F.lit(since).cast("timestamp_ntz")) & (F.col("block_timestamp") < F.lit(as_of).cast("timestamp_ntz")))
    rows = active.select(F.to_date("block_timestamp").alias("period_date"), "claimer").distinct().join(first, "claimer")
    new = F.col("period_date") == F.col("first_day")
    return rows.groupBy("period_date").agg(F.count("*").alias("unique_claimers"), F.count_if(new).alias("new_claimers"), F.count_if(~new).alias("returning_claimers")).orderBy(F.desc("period_date")).limit(days)


def ubi_daily_summary(claims: DataFrame, prices: DataFrame, contract: str, as_of: date, days: int) -> DataFrame:
    """Twelve columns a day: claimed amounts of all time, 30, 7 and 1 days in tokens and US dollars, and per user.

    Totals before the window are one aggregate; in it, sums run over a dense spine that starts 29 days early. A day
    without a price is valued at 0. Unique claimers of 7 and 30 days come from exploded days, not a range join."""
    spark = claims.sparkSession
    start, end = as_of - timedelta(days=days), as_of - timedelta(days=1)
    window_start = start - timedelta(days=29)
    rows = claims.where((F.col("contract_address") == contract) & (F.col("block_timestamp") < F.lit(as_of).cast("timestamp_ntz")))
    per_user = rows.groupBy(F.to_date("block_timestamp").alias("date"), "claimer").agg(F.sum("amount_g").alias("claimed"))
    daily = per_user.groupBy("date").agg(F.sum("claimed").alias("gd"), F.percentile_approx(F.col("claimed").cast("double"), 0.5, 10_000).alias("median"))
    price = prices.groupBy("day").agg(F.avg("price").alias("price")).select(F.col("day").alias("date"), F.col("price").cast("decimal(12,4)").alias("price"))
    valued = daily.join(price, "date", "left").withColumn("usd", (money(F.col("gd")) * F.coalesce("price", F.lit(0).cast("decimal(12,4)"))).cast(USD))
    before = valued.where(F.col("date") < F.lit(window_start)).agg(F.sum("gd").alias("gd0"), F.sum("usd").alias("usd0"))
    spine = date_spine(spark, window_start, end, "date")
    dense = spine.join(valued, "date", "left").select("date", F.coalesce(F.col("gd").cast("decimal(38,2)"), F.lit(0)).alias("gd"), F.coalesce("usd", F.lit(0)).alias("usd"), "median").crossJoin(F.broadcast(before))  # one row
    w = {n: over_days((), "date", n) for n in (29, 6)} | {0: over_days((), "date")}
    total = lambda c: F.sum(c).over(w[0]).cast("double") + F.coalesce(F.col(f"{c}0").cast("double"), F.lit(0.0))
    last = lambda c, n: F.sum(c).over(w[n]).cast("double")
    out = dense.select(
        "date", total("gd").alias("total_gd_all_time"), total("usd").alias("total_usd_all_time"), last("gd", 29).alias("gd_30d"), last("usd", 29).alias("usd_30d"), last("gd", 6).alias("gd_7d"), last("usd", 6).alias("usd_7d"),
        F.col("gd").cast("double").alias("gd_1d"), F.col("usd").cast("double").alias("usd_1d"), F.coalesce("median", F.lit(0.0)).alias("gd_per_user_1d"),
    )
    unique = [rolling_distinct(per_user, "date", "claimer", n, f"u{n}", start, end) for n in (7, 30)]
    out = out.where(F.col("date") >= F.lit(start)).join(unique[0], "date", "left").join(unique[1], "date", "left")
    per = lambda n: F.try_divide(F.col(f"gd_{n}d"), F.nullif(F.col(f"u{n}").cast("double"), F.lit(0.0))).alias(f"gd_per_user_{n}d")
    return out.select("date", "total_gd_all_time", "total_usd_all_time", "gd_30d", "usd_30d", per(30), "gd_7d", "usd_7d", per(7), "gd_1d", "usd_1d", "gd_per_user_1d")


#: Titles of the summary's columns on a dashboard.
TITLES = {
    "date": "Date", "total_gd_all_time": "Total claimed (all time)", "total_usd_all_time": "Total claimed USD (all time)", "gd_30d": "Claimed last 30d (all users)", "usd_30d": "Claimed USD last 30d (all users)", "gd_per_user_30d": "Per user 30d",
    "gd_7d": "Claimed last 7d (all users)", "usd_7d": "Claimed USD last 7d (all users)", "gd_per_user_7d": "Per user 7d", "gd_1d": "Claimed last 1d (all users)", "usd_1d": "Claimed USD last 1d (all users)", "gd_per_user_1d": "Per user 1d",
}


def titled(summary: DataFrame) -> DataFrame:
    return summary.withColumnsRenamed(TITLES)
