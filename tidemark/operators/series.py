"""Day series: dense spines, rolling sums, rolling distinct counts, carry-forward."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def date_spine(spark: SparkSession, first: date, last: date, name: str = "day") -> DataFrame:
    """One row a day, both ends included; none if last is before first."""
    n = max(0, (last - first).days + 1)
    return spark.range(n).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias(name))


def spine_of(df: DataFrame, day: str, *keys: str) -> DataFrame:
    """Every day from the first to the last of each key, from one aggregate row a key."""
    ends = df.groupBy(*keys).agg(F.min(day).alias("lo"), F.max(day).alias("hi")).where("lo is not null")
    return ends.select(*keys, F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(day))


def rolling_distinct(rows: DataFrame, day: str, key: str, days: int, name: str, first: date | None = None, last: date | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct keys in the `days` days up to each day, on the days that count any. Null keys count nowhere.

    A key's days, each good for `days` days, join into intervals; an interval is +1 where it begins and -1 after its end,
    and the sums of these by day run up to the count. So a key has two rows an interval, however long the window is, and
    rows that no day from first to last can count are not read."""
    rows = rows.where(F.col(key).isNotNull())
    if first is not None:
        rows = rows.where(F.col(day) >= F.lit(first - timedelta(days=days - 1)))
    if last is not None:
        rows = rows.where(F.col(day) <= F.lit(last))
    w = Window.partitionBy(*by, key).orderBy(day)
    seen = rows.select(*by, day, key).distinct().withColumns({"__gap": F.datediff(day, F.lag(day).over(w)), "__next": F.datediff(F.lead(day).over(w), day)})
    edge = lambda gap, at, step: F.when(F.col(gap).isNull() | (F.col(gap) > days), F.struct(at.alias(day), F.lit(step).alias("__step")))
    edges = seen.select(*by, F.explode(F.array(edge("__gap", F.col(day), 1), edge("__next", F.date_add(day, days), -1))).alias("__e")).where("__e is not null")
    daily = edges.select(*by, "__e.*").groupBy(*by, day).agg(F.sum("__step").alias("__step"))
    dense = spine_of(daily, day, *by).join(daily, [*by, day], "left")
    each = dense.select(*by, day, F.sum(F.coalesce("__step", F.lit(0))).over(over_days(by, day)).alias(name)).where(F.col(name) > 0)
    if first is not None:
        each = each.where(F.col(day) >= F.lit(first))
    return each if last is None else each.where(F.col(day) <= F.lit(last))


def over_days(by: tuple[str, ...], day: str, before: int | None = None) -> Window:
    """Rows up to the current one: all, or the last before + 1. The rows must be dense in days for the latter."""
    start = Window.unboundedPreceding if before is None else -before
    return Window.partitionBy(*by).orderBy(day).rowsBetween(start, 0)


def rolling_sum(daily: DataFrame, day: str, value: str, days: int, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Sum of the last `days` days on every day between the first and the last of the series, gaps counting 0; nothing if
    there are no rows at all."""
    dense = spine_of(daily, day, *by).join(daily, [*by, day], "left")
    return dense.select(*by, day, F.sum(F.coalesce(value, F.lit(0))).over(over_days(by, day, days - 1)).alias(name))


def carry_forward(value: Column, by: tuple[str, ...], day: str, strictly_before: bool = False) -> Column:
    """The latest value up to the day (or before it)."""
    w = Window.partitionBy(*by).orderBy(day).rowsBetween(Window.unboundedPreceding, -1 if strictly_before else 0)
    return F.last(value, ignorenulls=True).over(w)


def price_series(days: DataFrame, prices: DataFrame, day: str, price: str, fill: bool) -> DataFrame:
    """A price for each day. fill=False is the literal reading of window values that don't skip nulls: a day without a
    price has none. fill=True takes the last earlier price, else the first later one."""
    joined = days.join(prices.select(day, price), day, "left")
    if not fill:
        return joined
    back = F.last(price, ignorenulls=True).over(Window.orderBy(day).rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(price, ignorenulls=True).over(Window.orderBy(day).rowsBetween(0, Window.unboundedFollowing))
    return joined.select(day, F.coalesce(back, ahead).alias(price))


def cumulative_distinct(rows: DataFrame, day: str, key: str, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Exact number of distinct keys up to each day that has a first-seen key: each key counts on its first day."""
    first = rows.where(F.col(key).isNotNull()).groupBy(*by, key).agg(F.min(day).alias(day))
    return first.groupBy(*by, day).agg(F.count("*").alias("n")).select(*by, day, F.sum("n").over(over_days(by, day)).alias(name))
