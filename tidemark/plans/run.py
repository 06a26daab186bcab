"""One run of the fact table: adapters in order of what they need, each apart from the failures of the others."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, timedelta
from graphlib import TopologicalSorter

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.amounts import scale_by
from tidemark.plans import facts as f
from tidemark.plans.registry import METRICS

COMPUTED = {"Computed", "SupplyComputed", "XdcReserveComputed"}


@dataclass(frozen=True)
class Adapter:
    """fetch: what is known so far (KEY and value) -> rows of KEY, value, source. It runs after the adapters it needs."""

    name: str
    fetch: Callable[[DataFrame], DataFrame]
    needs: tuple[str, ...] = ()

    @property
    def metrics(self) -> list[tuple[str, str]]:
        kinds = COMPUTED if self.name == "Computed" else {self.name}
        mine = lambda m: m.adapter in kinds and m.spec.get("type") != "computed" or self.name == "Computed" and m.spec.get("type") == "computed"
        return [(c, m.key) for m in METRICS.values() if mine(m) for c in m.chains]


class Upstream:
    """Results of plans that several adapters read, by name: each is planned once and kept on the executors' disks, where
    what is lost is computed anew."""

    def __init__(self, plans: dict[str, Callable[[], DataFrame]]):
        self.plans, self.kept = plans, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.kept:
            self.kept[name] = self.plans[name]().persist(StorageLevel.DISK_ONLY)
        return self.kept[name]

    def release(self) -> None:
        for df in self.kept.values():
            df.unpersist()
        self.kept.clear()


def in_order(adapters: Iterable[Adapter]) -> list[Adapter]:
    """Each after those that it needs; otherwise as given."""
    by_name = {a.name: a for a in adapters}
    return [by_name[n] for n in TopologicalSorter({a.name: [n for n in a.needs if n in by_name] for a in by_name.values()}).static_order()]


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "date date, chain string, metric_key string, value double, source string")


def run_facts(spark: SparkSession, adapters: Iterable[Adapter], history: DataFrame | None = None, days: int = 1, budget: float | None = None, clock: Callable[[], float] = time.monotonic) -> tuple[DataFrame, list[dict]]:
    """The rows of all adapters, rounded as registered, and one health entry for each registered (chain, metric).

    An adapter that fails gives an error for each of its metrics; the run goes on, and what others computed stays. Once
    `budget` seconds are over, the rest are left out with a warning. A metric without rows is a warning too. The driver
    gets one count for each registered metric, never values."""
    began, done, health = clock(), nothing(spark), []
    for a in in_order(adapters):
        start, counts, problem = clock(), {}, None
        if budget is not None and start - began >= budget:
            problem = ("warn", "skipped: time is over")
        else:
            try:
                rows = f.with_decimals(a.fetch(f.known(done, history)).select(*f.KEY, "value", "source")).repartition("date").persist(StorageLevel.DISK_ONLY)
                counts = {(r["chain"], r["metric_key"]): r["n"] for r in rows.groupBy("chain", "metric_key").agg(F.count("*").alias("n")).collect()}  # as many as are registered
                done = done.unionByName(rows)
            except Exception as e:  # noqa: BLE001 - what it was is in the health rows
                problem = ("error", f"{type(e).__name__}: {str(e).splitlines()[0][:200]}")
        took = int(1000 * (clock() - start))
        for chain, key in a.metrics:
            n = counts.get((chain, key), 0)
            status, details = problem or (("ok", "") if n else ("warn", "no rows"))
            health.append({"adapter": a.name, "chain": chain, "metric_key": key, "status": status, "records_written": n, "records_expected": days, "details": details, "elapsed_ms": took})
    return done, health


def supply(snapshot: DataFrame, as_of: date, fallback: dict[str, float]) -> DataFrame:
    """Facts of fetched supplies, dated yesterday. Snapshot: metric_key, raw (text), decimals. A supply that wasn't fetched
    has its fallback, or no row where there is none."""
    registered = [(m.chains[0], m.key, fallback.get(m.key)) for m in METRICS.values() if m.adapter == "Supply"]
    wanted = snapshot.sparkSession.createDataFrame(registered, "chain string, metric_key string, other double")
    got = snapshot.groupBy("metric_key").agg(F.max(scale_by(F.col("raw"), F.col("decimals"))).cast("double").alias("value"))
    rows = wanted.join(got, "metric_key", "left").select(F.lit(as_of - timedelta(days=1)).alias("date"), "chain", "metric_key", F.coalesce("value", "other").alias("value"))
    return f.facts(rows, "SUPPLY")


def reserve(prices: DataFrame, swaps: DataFrame) -> DataFrame:
    """Daily mean price and swapped amounts of the first chain's reserve. Prices: day, price; swaps: day, direction, amount."""
    price = f.to_long(f.daily_price(prices), "CELO", {"celo_gd_price": "price"}, "RESERVE", "day")
    columns = {m.key: m.spec["field"] for m in METRICS.values() if m.adapter == "Reserve" and "field" in m.spec}
    return price.unionByName(f.to_long(f.reserve_volume(swaps), "CELO", columns, "RESERVE", "day"))


def other_reserve(prices: DataFrame, balances: DataFrame) -> DataFrame:
    """Price (date, raw, decimals) and US dollars of collateral (date, raw, decimals of each token) of the second chain's."""
    price = prices.select("date", scale_by(F.col("raw"), F.col("decimals")).cast("double").alias("value"))
    rows = price.withColumn("metric_key", F.lit("xdc_gd_price")).unionByName(f.collateral(balances).withColumn("metric_key", F.lit("xdc_reserve_liquidity_usd")))
    return f.facts(rows.withColumn("chain", F.lit("XDC")), "XDC_RESERVE")


def invite_facts(long: DataFrame) -> DataFrame:
    return f.facts(long.withColumn("chain", F.lit("XDC")), "XDC_INVITES")


def every_rule() -> dict:
    return f.returning_rules() | f.usd_rules() | f.supply_rules() | f.reserve_rules()


def computed_adapter(needs: Iterable[str]) -> Adapter:
    return Adapter("Computed", lambda values: f.computed(values, every_rule()), tuple(needs))


def smart_backfill(spark: SparkSession, store: DataFrame, run: Callable[[date], tuple[DataFrame, list[dict]]], as_of: date, genesis: dict[str, date], lookback: int = 90) -> tuple[DataFrame, list[dict]]:
    """Runs once from the first day that any metric needs, and keeps of it what is missing: keys that are not stored, from
    the day on that their own metric needs, up to yesterday. run: first day -> (rows, health). Nothing runs if nothing is
    needed."""
    preview = f.backfill_preview(store, as_of, genesis, lookback)
    since = f.earliest_needed(preview).first()["earliest"]
    if since is None:
        return nothing(spark), []
    rows, health = run(since)
    due = preview.where("days_needed > 0").select("chain", "metric_key", "start_date")
    wanted = rows.join(F.broadcast(due), ["chain", "metric_key"]).where((F.col("date") >= F.col("start_date")) & (F.col("date") < F.lit(as_of)))  # due: a row a registered metric
    return f.facts_append(wanted.select(*f.KEY, "value", "source"), store), health
