"""Data-quality checks. Each returns the rows or keys that fail, so an empty result is a pass."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))


def relationship(df: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    keys = parent.select(F.col(key).alias("__k"))
    return df.where(F.col(column).isNotNull()).join(keys, df[column] == keys["__k"], "left_anti")


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def no_later_than(df: DataFrame, ts: str, limit: datetime) -> DataFrame:
    return df.where(F.col(ts) >= F.lit(limit).cast("timestamp_ntz"))


def reconcile(df: DataFrame, total: Column, parts: Column) -> DataFrame:
    """Rows where a total differs from the sum of its parts."""
    return df.where(~total.eqNullSafe(parts))


def failures(tests: dict[str, DataFrame]) -> DataFrame:
    """One row a test: its name, the number of failures and a status."""
    out = None
    for name, df in tests.items():
        row = df.agg(F.count("*").alias("failures")).select(F.lit(name).alias("test"), "failures", F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"))
        out = row if out is None else out.unionByName(row)
    return out


def freshness(df: DataFrame, loaded_at: str, now: datetime, warn_hours: int = 36, error_hours: int = 72) -> DataFrame:
    """Age of the newest row in hours and its status."""
    age = (F.unix_micros(F.lit(now)) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))) / F.lit(3_600_000_000)
    status = F.when(F.col("max_loaded_at").isNull() | (F.col("age_hours") > error_hours), "error").when(F.col("age_hours") > warn_hours, "warn").otherwise("pass")
    return df.agg(F.max(loaded_at).alias("max_loaded_at")).withColumn("age_hours", age).withColumn("status", status)
