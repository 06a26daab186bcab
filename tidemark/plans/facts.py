"""Daily facts: long rows (date, chain, metric_key, value, source) from adapters, joined by what they depend on."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.amounts import scale_by
from tidemark.functions.naming import base_metric
from tidemark.operators.keyed import layered, new_keys_only
from tidemark.operators.series import carry_forward, rolling_sum, spine_of
from tidemark.plans.registry import CHAINS, METRICS, Metric

KEY = ["date", "chain", "metric_key"]
EXACT = "decimal(24,4)"


def facts(rows: DataFrame, source: str) -> DataFrame:
    return rows.where("value is not null").select("date", "chain", "metric_key", F.col("value").cast("double").alias("value"), F.lit(source).alias("source"))


def to_long(daily: DataFrame, chain: str, columns: dict[str, str], source: str, day: str = "date") -> DataFrame:
    """One row for each (day, metric) of a wide daily table; columns: metric key -> column. Nulls yield no row."""
    wide = daily.select(F.col(day).alias("date"), *[F.col(c).cast("double").alias(k) for k, c in columns.items()])
    return facts(wide.unpivot(["date"], list(columns), "metric_key", "value").withColumn("chain", F.lit(chain)), source)


def table_metrics(source: str, daily: DataFrame, day: str = "date") -> DataFrame:
    """Facts of all registered metrics that are columns of a plan, taken by name."""
    columns = {m.key: m.spec["column"] for m in METRICS.values() if m.spec.get("source") == source and m.spec["column"] in daily.columns}
    return to_long(daily, "CELO", columns, source.upper(), day)


def wide(values: DataFrame, *keys: str) -> DataFrame:
    """A row a day with the named metrics side by side: the metrics are few and known, so this is one aggregation."""
    return values.where(F.col("metric_key").isin(*keys)).groupBy("date").agg(*[F.max(F.when(F.col("metric_key") == k, F.col("value"))).alias(k) for k in keys])


def known(batch: DataFrame, history: DataFrame | None) -> DataFrame:
    """Values by key: the batch shadows what is stored."""
    values = batch.select(*KEY, "value")
    return values if history is None else layered(values, history.select(*KEY, "value"), KEY, "value")


def times_price(value: Column, price: Column, decimals: int) -> Column:
    """An exact product of a value and a price with four decimals each, rounded half up."""
    return F.round(value.cast(EXACT) * price.cast("decimal(12,4)"), decimals).cast("double")


def returning_rules(chain: str = "xdc") -> dict[tuple[str, str], Column]:
    """max(0, active - new) where both are known."""
    dau, new = F.col(f"{chain}_dau"), F.col(f"{chain}_new_claimers")
    return {(chain.upper(), f"{chain}_returning_claimers"): F.when(dau.isNotNull() & new.isNotNull(), F.greatest(F.lit(0.0), dau - new))}


def usd_rules() -> dict[tuple[str, str], Column]:
    """Token amounts at the same day's price; nothing without a price, or at a price of 0."""
    out = {}
    for m in METRICS.values():
        if m.adapter == "Computed":
            price = F.col("xdc_gd_price" if m.chains[0] == "XDC" else "celo_gd_price")
            out[m.chains[0], m.key] = F.when(price != 0, times_price(F.col(m.spec["source"]), price, m.decimals))
    return out


def supply_rules() -> dict[tuple[str, str], Column]:
    """Circulating supply of one chain, and of four chains only where all four are known (a sum with a null is null)."""
    eth = F.col("eth_gd_total_supply") - F.col("eth_gd_frozen_supply")
    total = eth + F.col("fuse_gd_in_circulation") + F.col("celo_gd_in_circulation") + F.col("xdc_gd_in_circulation")
    return {("ETH", "eth_gd_in_circulation"): eth, ("AGG", "agg_gd_in_circulation"): total}


def reserve_rules() -> dict[tuple[str, str], Column]:
    """Price spread, backing ratio, minted amount, and growth against the calendar day before (not the row before)."""
    liquidity, w = F.col("xdc_reserve_liquidity_usd"), Window.orderBy("date")
    before = F.when(F.lag("date").over(w) == F.date_sub("date", 1), F.lag(liquidity).over(w))
    return {
        ("XDC", "gd_price_spread"): F.col("xdc_gd_price") - F.col("celo_gd_price"), ("XDC", "xdc_reserve_backing_ratio"): F.when(F.col("xdc_gd_in_circulation") > 0, F.try_divide(liquidity, F.col("xdc_gd_in_circulation"))),
        ("XDC", "xdc_daily_gd_minted"): F.col("xdc_gd_claimed_1d"), ("XDC", "xdc_reserve_growth_abs"): liquidity - before,
    }


#: All metrics that the rules read.
NEEDS = sorted({m.spec["source"] for m in METRICS.values() if m.adapter == "Computed"} | {"xdc_dau", "xdc_new_claimers", "xdc_gd_price", "celo_gd_price", "eth_gd_total_supply", "eth_gd_frozen_supply", "fuse_gd_in_circulation", "celo_gd_in_circulation", "xdc_gd_in_circulation", "xdc_reserve_liquidity_usd", "xdc_gd_claimed_1d"})


def computed(values: DataFrame, rules: dict[tuple[str, str], Column]) -> DataFrame:
    """Rows of computed metrics: one aggregation puts a day's values side by side (a row a day from here on), and each rule
    is an expression on it."""
    cells = [F.struct(F.lit(chain).alias("chain"), F.lit(key).alias("metric_key"), value.alias("value")) for (chain, key), value in rules.items()]
    days = wide(values, *NEEDS).select("date", *[c.alias(f"r{i}") for i, c in enumerate(cells)])
    return facts(days.select("date", F.inline(F.array(*[f"r{i}" for i in range(len(cells))]))), "COMPUTED")


def returning_claimers(values: DataFrame) -> DataFrame:
    return computed(values, returning_rules())


def usd_computed(values: DataFrame) -> DataFrame:
    return computed(values, usd_rules())


def supply_computed(values: DataFrame) -> DataFrame:
    return computed(values, supply_rules())


def reserve_computed(values: DataFrame) -> DataFrame:
    return computed(values, reserve_rules())


def price_warnings(values: DataFrame, metrics: list[Metric] | None = None) -> DataFrame:
    """Days of priced metrics that have an amount but no price: date, metric_key, details."""
    metrics = metrics or [m for m in METRICS.values() if m.adapter == "Computed"]
    target = F.element_at(F.create_map(*[F.lit(x) for m in metrics for x in (m.spec["source"], m.key)]), F.col("metric_key"))
    priced = values.where((F.col("metric_key") == "xdc_gd_price") & (F.col("value") != 0)).select("date")
    rows = values.where(F.col("metric_key").isin(*[m.spec["source"] for m in metrics])).join(priced, "date", "left_anti")
    return rows.select("date", target.alias("metric_key"), F.concat(F.lit("price not available for "), F.col("date").cast("string"), F.lit(" - row skipped")).alias("details"))


def with_decimals(rows: DataFrame) -> DataFrame:
    """Values rounded to the registered decimals of their metric (2, where it has none)."""
    by = {}
    for m in METRICS.values():
        by.setdefault(m.decimals, []).append(m.key)
    value = F.col("value").cast("decimal(38,10)")
    out = F.round(value, 2)
    for dp, keys in by.items():
        out = F.when(F.col("metric_key").isin(*keys), F.round(value, dp).cast("double")).otherwise(out.cast("double"))
    return rows.withColumn("value", out)


def facts_build(batch: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """A batch of fetched facts and all that is computed from it and from stored facts, in order of dependency: prices and
    supplies come first wherever they come from, so a day is valued in the run that brings its price."""
    rules = returning_rules() | usd_rules() | supply_rules() | reserve_rules()
    return with_decimals(batch.select(*KEY, "value", "source").unionByName(computed(known(batch, history), rules)))


def facts_agg(batch: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Sums over chains of the metrics registered for it, on the days of the batch: each chain once, from the batch or
    else from storage."""
    bases = {}
    for m in METRICS.values():
        if m.aggregate:
            bases.setdefault(m.key.split("_", 1)[1], m.decimals)
    values = known(batch, history).join(batch.select("date").distinct(), "date", "left_semi")
    rows = values.where(F.col("chain").isin(*CHAINS)).withColumn("base", base_metric(F.col("metric_key"))).where(F.col("base").isin(*bases) & (F.col("metric_key") == F.concat(F.lower("chain"), F.lit("_"), F.col("base"))))
    sums = rows.groupBy("date", "base").agg(F.sum(F.col("value").cast("decimal(30,8)")).alias("total"))
    zero = [b for b, dp in bases.items() if dp == 0]
    total = F.when(F.col("base").isin(*zero), F.round("total", 0).cast("double")).otherwise(F.round("total", 2).cast("double"))
    return sums.select("date", F.lit("AGG").alias("chain"), F.concat(F.lit("agg_"), "base").alias("metric_key"), total.alias("value"), F.lit("AGG").alias("source"))


def facts_append(batch: DataFrame, store: DataFrame, merge: bool = False) -> DataFrame:
    """What a run adds to the fact table: a stored key is never corrected, unless merge is set."""
    return new_keys_only(batch, store, KEY, merge)


def daily_price(events: DataFrame, day: str = "day", price: str = "price") -> DataFrame:
    """The mean price of each day, over a dense spine; a day without a price event has that of the last day before it."""
    mean = events.groupBy(day).agg((F.sum(price) / F.count(price)).alias("own"))
    dense = spine_of(mean, day).join(mean, day, "left")
    return dense.select(day, F.coalesce(F.col("own"), carry_forward(F.col("own"), (), day, strictly_before=True)).alias(price), F.when(F.col("own").isNull(), "carried").otherwise("observed").alias("kind"))


def reserve_volume(swaps: DataFrame) -> DataFrame:
    """By day: amounts in, out and both. Swaps: day, direction ("in" or "out"), amount."""
    part = lambda d: F.coalesce(F.sum(F.when(F.col("direction") == d, F.col("amount"))), F.lit(0))
    return swaps.groupBy("day").agg(part("in").alias("amount_in"), part("out").alias("amount_out")).withColumn("volume", F.col("amount_in") + F.col("amount_out"))


def rolling_sum_nd(daily: DataFrame, days: int, by: tuple[str, ...] = ()) -> DataFrame:
    return rolling_sum(daily, "date", "value", days, "value", by)


def collateral(balances: DataFrame) -> DataFrame:
    """US dollars in a reserve: token balances by their decimals, added up exactly. Balances: date, raw, decimals."""
    return balances.groupBy("date").agg(F.sum(scale_by(F.col("raw"), F.col("decimals"))).cast("double").alias("value"))


def supply_or(value: Column, fallback: float) -> Column:
    """A fetched supply, or a constant when the fetch gave none."""
    return F.coalesce(value, F.lit(fallback))


def gap_report(stored: DataFrame) -> DataFrame:
    """By (chain, metric): first and last day, days expected between them, days there, and how many are missing."""
    one = stored.groupBy("chain", "metric_key").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.countDistinct("date").alias("actual_days"))
    return one.withColumn("expected_days", F.datediff("last_date", "first_date") + 1).withColumn("missing_days", F.col("expected_days") - F.col("actual_days"))


def missing_days(stored: DataFrame) -> DataFrame:
    """The days that gap_report() misses."""
    return spine_of(stored, "date", "chain", "metric_key").join(stored.select(*KEY), KEY, "left_anti")


def expected(spark, chains: tuple[str, ...] = (*CHAINS, "AGG")) -> DataFrame:
    rows = [(c, m.key) for m in METRICS.values() for c in m.chains if c in chains]
    return spark.createDataFrame(rows, "chain string, metric_key string")


def coverage_report(stored: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Registered (chain, metric) pairs and whether they have a row in the last days up to yesterday."""
    since = as_of - timedelta(days=days)
    seen = stored.where(F.col("date") >= F.lit(since)).select("chain", "metric_key").distinct().withColumn("seen", F.lit(True))
    return expected(stored.sparkSession).join(seen, ["chain", "metric_key"], "left").select("chain", "metric_key", F.when(F.col("seen"), "present").otherwise("missing").alias("status"))


def backfill_preview(stored: DataFrame, as_of: date, genesis: dict[str, date], lookback: int = 90) -> DataFrame:
    """Days that each registered metric needs: from the day after its last one, from the chain's first day, or from a
    default number of days back."""
    yesterday = as_of - timedelta(days=1)
    last = stored.groupBy("chain", "metric_key").agg(F.max("date").alias("last_date"))
    rows = expected(stored.sparkSession).join(last, ["chain", "metric_key"], "left")
    floor = F.coalesce(*[F.when(F.col("chain") == c, F.lit(d)) for c, d in genesis.items()], F.lit(None).cast("date"))
    start = F.coalesce(F.date_add("last_date", 1), floor, F.lit(yesterday - timedelta(days=lookback)))
    start = F.greatest(start, floor)
    return rows.select("chain", "metric_key", "last_date", start.alias("start_date")).withColumn("days_needed", F.greatest(F.lit(0), F.datediff(F.lit(yesterday), "start_date") + 1))


def earliest_needed(preview: DataFrame) -> DataFrame:
    """The first day that any metric of a real chain needs."""
    return preview.where("chain <> 'AGG' and days_needed > 0").agg(F.min("start_date").alias("earliest"))


def fill_prices(stored: DataFrame, observed: DataFrame, key: str, chain: str) -> DataFrame:
    """Rows for the days of a stored price series that are missing, at the observed price of the day or else the last one."""
    spine = spine_of(stored.where(F.col("metric_key") == key), "date").join(observed.select("date", F.col("price").alias("o")), "date", "left")
    own = stored.where(F.col("metric_key") == key).select("date", F.col("value").alias("v"))
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    rows = spine.join(own, "date", "left").withColumn("value", F.last(F.coalesce("v", "o"), ignorenulls=True).over(w)).where("v is null")
    return facts(rows.select("date", F.lit(chain).alias("chain"), F.lit(key).alias("metric_key"), "value"), "CARRIED")
