from datetime import date, datetime
from decimal import Decimal

import pytest

from tidemark.plans import facts, run
from tidemark.plans.registry import METRICS
from tidemark.sources.sinks import health_rows

FACTS = "date date, chain string, metric_key string, value double, source string"
DAY = date(2024, 1, 2)


def fixed(spark, *rows):
    return lambda known: spark.createDataFrame([(*r, "T") for r in rows], FACTS)


def broken(known):
    raise RuntimeError("no answer\nmore")


def test_adapters_cover_the_registry():
    names = ["Table", "Subgraph", "Reserve", "Supply", "XdcReserve", "XdcInvites"]
    every = [k for n in names for _, k in run.Adapter(n, broken).metrics] + [k for _, k in run.computed_adapter(names).metrics]
    assert sorted(every) == sorted(METRICS)


def test_what_is_needed_runs_first(spark):
    got = run.in_order([run.computed_adapter(["Reserve", "absent"]), run.Adapter("Reserve", broken), run.Adapter("Table", broken)])
    assert [a.name for a in got].index("Reserve") < [a.name for a in got].index("Computed") and len(got) == 3


def test_a_failing_adapter_is_apart_from_the_others(spark):
    reserve = run.Adapter("XdcReserve", fixed(spark, (DAY, "XDC", "xdc_gd_price", 0.5), (DAY, "XDC", "xdc_reserve_liquidity_usd", 8.0)))
    entities = run.Adapter("Subgraph", fixed(spark, (DAY, "XDC", "xdc_gd_claimed_1d", 3.0)))
    lazy = run.Adapter("Supply", lambda known: spark.createDataFrame([("x",)], "v string").selectExpr("date'2024-01-02' as date", "'ETH' as chain", "'eth_gd_total_supply' as metric_key", "cast(v as double) as value", "'T' as source"))
    rows, health = run.run_facts(spark, [run.computed_adapter(["XdcReserve", "Subgraph", "Table"]), run.Adapter("Table", broken), lazy, reserve, entities])
    got = {r["metric_key"]: r["value"] for r in rows.collect()}
    assert got == {"xdc_gd_price": 0.5, "xdc_reserve_liquidity_usd": 8.0, "xdc_gd_claimed_1d": 3.0, "xdc_usd_claimed_1d": 1.5, "xdc_daily_gd_minted": 3.0}
    status = {h["metric_key"]: (h["status"], h["details"]) for h in health}
    assert status["celo_dau"] == ("error", "RuntimeError: no answer")
    assert status["eth_gd_total_supply"][0] == "error"  # it fails when it is computed, not when it is planned
    assert status["xdc_usd_claimed_1d"] == ("ok", "") and status["xdc_dau"] == ("warn", "no rows")
    table = health_rows(spark, "r", DAY, datetime(2024, 1, 3), [{k: v for k, v in h.items()} for h in health])
    summary = table.where("adapter = 'SUMMARY'").first()
    assert summary["status"] == "error" and summary["records_written"] == 5


def test_what_is_done_stays_when_time_is_over(spark):
    ticks = iter([0.0, 1.0, 20.0, 20.0, 21.0, 21.0, 22.0])
    first = run.Adapter("XdcReserve", fixed(spark, (DAY, "XDC", "xdc_gd_price", 0.5)))
    rows, health = run.run_facts(spark, [first, run.Adapter("Table", broken)], budget=10, clock=lambda: next(ticks))
    assert [r["metric_key"] for r in rows.collect()] == ["xdc_gd_price"]
    assert {h["status"] for h in health if h["adapter"] == "Table"} == {"warn"} and all("time" in h["details"] for h in health if h["adapter"] == "Table")


def test_history_serves_what_the_run_does_not_bring(spark):
    history = fixed(spark, (DAY, "XDC", "xdc_gd_price", 2.0))(None)
    rows, _ = run.run_facts(spark, [run.Adapter("Subgraph", fixed(spark, (DAY, "XDC", "xdc_gd_claimed_1d", 3.0))), run.computed_adapter(["Subgraph"])], history)
    assert {r["metric_key"]: r["value"] for r in rows.collect()}["xdc_usd_claimed_1d"] == 6.0


def test_shared_results_are_planned_once(spark):
    calls = []
    shared = run.Upstream({"a": lambda: calls.append(1) or spark.range(3)})
    assert shared["a"].count() == shared["a"].count() == 3 and calls == [1]
    shared.release()
    assert not shared.kept


def test_supplies_fall_back_and_collateral_is_exact(spark):
    raw = spark.createDataFrame([("eth_gd_frozen_supply", "250", 2), ("eth_gd_total_supply", "many", 2)], "metric_key string, raw string, decimals int")
    got = {r["metric_key"]: (r["date"], r["value"]) for r in run.supply(raw, date(2024, 1, 3), {"eth_gd_total_supply": 9.0}).collect()}
    assert got == {"eth_gd_frozen_supply": (DAY, 2.5), "eth_gd_total_supply": (DAY, 9.0)}
    b = spark.createDataFrame([(DAY, "1000001", 6), (DAY, "2" + "0" * 18, 18), (DAY, None, 6)], "date date, raw string, decimals int")
    assert [r["value"] for r in facts.collateral(b).collect()] == [3.000001]
    exact = facts.scale_by(b["raw"], b["decimals"])
    assert b.select(exact.alias("x")).first()["x"] == Decimal("1.000001")


@pytest.mark.parametrize("last, days", [(date(2024, 1, 30), 0), (date(2024, 1, 28), 2)])
def test_backfill_takes_only_what_is_missing(spark, last, days):
    everything = [(c, m.key) for m in METRICS.values() for c in m.chains]
    store = spark.createDataFrame([(last if k == "xdc_dau" else date(2024, 1, 30), c, k, 1.0, "T") for c, k in everything], FACTS)
    asked = []

    def again(since):
        asked.append(since)
        return fixed(spark, *[(date(2024, 1, d), "XDC", k, 7.0) for d in (27, 28, 29, 30, 31) for k in ("xdc_dau", "xdc_new_claimers")])(None), [{"status": "ok"}]

    rows, health = run.smart_backfill(spark, store, again, date(2024, 1, 31), {})
    assert sorted((r["metric_key"], r["date"].day) for r in rows.collect()) == [("xdc_dau", d) for d in range(31 - days, 31)]
    assert asked == ([date(2024, 1, 29)] if days else []) and bool(health) == bool(days)
