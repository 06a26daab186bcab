from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.plans import facts, invites, warehouse
from tidemark.plans.registry import METRICS
from tidemark.sources.ledger import ZERO_ADDRESS

T = lambda d, h=0: datetime(2024, 1, d, h)
CLAIM = "network string, chain_id long, block_number long, block_timestamp timestamp_ntz, tx_hash string, log_index long, contract_address string, claimer_address string, amount_raw string, amount_g decimal(37,18), ingested_at timestamp_ntz"
SIGNUP = "network string, chain_id long, block_number long, block_timestamp timestamp_ntz, tx_hash string, log_index long, user_address string, inviter_address string, signup_type string, inviter_level long, ingested_at timestamp_ntz"
PAYOUT = "network string, chain_id long, block_number long, block_timestamp timestamp_ntz, tx_hash string, log_index long, invitee_address string, total_amount_g decimal(37,18)"


def claim(who, at, network="celo"):
    return (network, 1, 1, at, f"c{at}", 0, "0xu", who, "100", Decimal(1), at)


def life(spark, signups, claims, payouts):
    s = spark.createDataFrame([(n, 1, 1, at, f"s{u}{at}", 0, u, "i", k, 0, at) for u, at, k, n in signups], SIGNUP)
    c = spark.createDataFrame(claims, CLAIM)
    p = spark.createDataFrame([("celo", 1, 1, at, f"p{at}", 0, u, Decimal(1500)) for u, at in payouts], PAYOUT)
    return {r["invitee_address"]: r for r in warehouse.invitee_lifecycle(s, c, p).collect()}


def test_lifecycle_boundaries(spark):
    signups = [("a", T(2), "referral", "celo"), ("a", T(3), "campaign", "celo"), ("b", T(2), "referral", "celo"), ("n", T(2), "no_code", "celo")]
    claims = [claim("a", T(1)), claim("a", T(2)), claim("a", T(3)), claim("a", T(11)), claim("a", T(11, 1)), claim("a", T(4), "xdc")]
    r = life(spark, signups, claims, [("a", T(4)), ("a", T(5))])
    assert set(r) == {"a", "b"}
    a = r["a"]
    assert (a["signup_timestamp"], a["bounty_timestamp"]) == (T(2), T(4))
    assert (a["total_claims_on_invite_network"], a["total_claims_all_networks"]) == (3, 4)  # before and at the signup don't count
    assert (a["post_payout_claims_7d"], a["post_payout_claims_30d"]) == (1, 2)  # exactly seven days later counts
    assert r["b"]["post_payout_claims_7d"] is None and r["b"]["total_claims_all_networks"] == 0


def test_paid_without_claims_is_zero(spark):
    r = life(spark, [("a", T(2), "referral", "celo")], [claim("x", T(1))], [("a", T(4))])["a"]
    assert (r["post_payout_claims_7d"], r["post_payout_claims_30d"], r["first_claim_timestamp"]) == (0, 0, None)


def test_funnel_eligibility_needs_seven_whole_days(spark):
    claims = [claim(u, T(25, h)) for u in "ab" for h in (1, 2, 3)]
    df = [("a", T(24), "referral", "celo"), ("b", T(24, 1), "referral", "celo")]
    s = spark.createDataFrame([(n, 1, 1, at, f"s{u}", 0, u, "i", k, 0, at) for u, at, k, n in df], SIGNUP)
    rows = warehouse.invite_funnel(warehouse.invitee_lifecycle(s, spark.createDataFrame(claims, CLAIM), spark.createDataFrame([], PAYOUT)), date(2024, 1, 31)).orderBy("stage_order").collect()
    assert [r["user_count"] for r in rows] == [2, 2, 2, 2, 1, 0]
    assert [r["pct_of_top"] for r in rows] == [100.0, 100.0, 100.0, 100.0, 50.0, 0.0]


def test_signup_kinds_and_payout_amounts(spark):
    cols = "network string, chain_id long, block_number long, block_timestamp timestamp_ntz, tx_hash string, log_index long, event_name string, contract_address string, inviter_address string, invitee_address string, inviter_level string, bounty_paid string, earned_level boolean, ingested_at timestamp_ntz"
    row = lambda event, inviter, paid, level: ("xdc", 50, 1, T(1), "t", 0, event, "0xc", inviter, "u", level, paid, True, T(1))
    df = spark.createDataFrame([row("InviteeJoined", i, None, "x") for i in (ZERO_ADDRESS, "0xc", "0xw")] + [row("InviterBounty", "0xw", "1000" + "0" * 18, "1"), row("InviterBounty", "0xc", "0", "2"), row("Other", "0xw", "1", "1")], cols)
    assert sorted((r["signup_type"], r["inviter_address"], r["inviter_level"]) for r in warehouse.invite_signups(df).collect()) == [("campaign", None, None), ("no_code", None, None), ("referral", "0xw", None)]
    p = {r["payout_origin"]: r for r in warehouse.invite_payouts(df).collect()}
    assert (p["referral"]["inviter_amount_g"], p["referral"]["total_amount_g"]) == (1000, 1500)
    assert (p["campaign"]["inviter_amount_g"], p["campaign"]["inviter_address"], p["campaign"]["total_amount_g"]) == (None, None, 500)


F_ = "date date, chain string, metric_key string, value double, source string"


def test_registry_is_complete():
    assert len(METRICS) == 104
    assert sum(m.aggregate for m in METRICS.values()) == 36


def test_usd_needs_a_price_and_growth_the_day_before(spark):
    d = lambda n: date(2024, 1, n)
    rows = [(d(1), "XDC", "xdc_gd_claimed_1d", 10.0), (d(2), "XDC", "xdc_gd_claimed_1d", 20.0), (d(2), "XDC", "xdc_gd_price", 0.5), (d(1), "XDC", "xdc_reserve_liquidity_usd", 5.0), (d(3), "XDC", "xdc_reserve_liquidity_usd", 8.0), (d(4), "XDC", "xdc_reserve_liquidity_usd", 9.0)]
    df = spark.createDataFrame([(*r, "T") for r in rows], F_)
    got = {(r["date"], r["metric_key"]): r["value"] for r in facts.facts_build(df).collect()}
    assert got[d(2), "xdc_usd_claimed_1d"] == 10.0 and (d(1), "xdc_usd_claimed_1d") not in got
    assert got[d(4), "xdc_reserve_growth_abs"] == 1.0 and (d(3), "xdc_reserve_growth_abs") not in got
    assert [r["metric_key"] for r in facts.price_warnings(df).collect()] == ["xdc_usd_claimed_1d"]


def test_total_supply_is_all_or_nothing(spark):
    d = date(2024, 1, 1)
    parts = [("ETH", "eth_gd_total_supply", 10.0), ("ETH", "eth_gd_frozen_supply", 4.0), ("FUSE", "fuse_gd_in_circulation", 1.0), ("CELO", "celo_gd_in_circulation", 2.0)]
    df = spark.createDataFrame([(d, *p, "T") for p in parts], F_)
    assert [r["metric_key"] for r in facts.supply_computed(df).collect()] == ["eth_gd_in_circulation"]
    more = df.unionByName(spark.createDataFrame([(d, "XDC", "xdc_gd_in_circulation", 3.0, "T")], F_))
    assert {r["metric_key"]: r["value"] for r in facts.supply_computed(more).collect()} == {"eth_gd_in_circulation": 6.0, "agg_gd_in_circulation": 12.0}


def test_aggregate_takes_the_batch_over_history(spark):
    d = date(2024, 1, 1)
    batch = spark.createDataFrame([(d, "CELO", "celo_p2p_tx_count", 2.0, "T")], F_)
    history = spark.createDataFrame([(d, "CELO", "celo_p2p_tx_count", 9.0, "T"), (d, "XDC", "xdc_p2p_tx_count", 5.0, "T"), (date(2023, 1, 1), "XDC", "xdc_p2p_tx_count", 5.0, "T")], F_)
    assert [(r["metric_key"], r["value"]) for r in facts.facts_agg(batch, history).collect()] == [("agg_p2p_tx_count", 7.0)]


def test_carried_prices_and_fills(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), 2.0), (date(2024, 1, 1), 4.0), (date(2024, 1, 3), 5.0)], "day date, price double")
    assert [(r["price"], r["kind"]) for r in facts.daily_price(df).orderBy("day").collect()] == [(3.0, "observed"), (3.0, "carried"), (5.0, "observed")]
    stored = spark.createDataFrame([(date(2024, 1, 1), "CELO", "celo_gd_price", 1.0, "T"), (date(2024, 1, 3), "CELO", "celo_gd_price", 3.0, "T")], F_)
    got = facts.fill_prices(stored, spark.createDataFrame([], "date date, price double"), "celo_gd_price", "CELO").collect()
    assert [(r["date"], r["value"]) for r in got] == [(date(2024, 1, 2), 1.0)]


def test_bounty_split_rules(spark):
    b = spark.createDataFrame([("t1", 0, "a", "b"), ("t2", 0, "s", "s"), ("t3", 0, "a", "b")], "tx_hash string, log_index long, inviter string, invitee string")
    t = spark.createDataFrame([("t1", "a", Decimal(10)), ("t1", "b", Decimal(5)), ("t1", "z", Decimal(2)), ("t2", "s", Decimal(3))], "tx_hash string, recipient string, amount_g decimal(37,18)")
    got = {r["tx_hash"]: tuple(int(r[c]) for c in ("inviter_paid_g", "invitee_paid_g", "campaign_returned_g", "total_paid_g")) for r in invites.bounty_split(b, t).collect()}
    assert got == {"t1": (10, 5, 2, 17), "t2": (3, 0, 0, 3), "t3": (0, 0, 0, 0)}


def test_invite_days_are_dense_and_unlabelled_counts_as_referral(spark):
    cols = "date date, event string, inviter string, invitee string, invite_type string, inviter_paid_g double, invitee_paid_g double, campaign_returned_g double, total_paid_g double"
    raw = spark.createDataFrame([(date(2024, 1, 1), "InviteeJoined", "a", "b", None, 0.0, 0.0, 0.0, 0.0), (date(2024, 1, 3), "InviterBounty", "a", "a", "", 1.0, 0.0, 0.0, 1.0)], cols)
    got = {(r["date"].day, r["metric_key"]): r["value"] for r in invites.invites_daily_long(raw, date(2024, 1, 5)).collect()}
    assert len(got) == 4 * 28
    assert got[1, "xdc_invites_referral_signups"] == 1 and got[2, "xdc_invites_referral_signups"] == 0 and got[4, "xdc_invites_referral_signups_at"] == 1
    assert got[3, "xdc_invites_unique_inviters"] == 1 and got[3, "xdc_invites_unique_invitees"] == 0 and got[4, "xdc_invites_total_unique_users_at"] == 1
    assert invites.invites_daily_long(raw.where(F.lit(False)), date(2024, 1, 5)).count() == 0


def test_lifecycle_scans_claims_once_and_prunes(spark, sf_dir):
    from tidemark.queries import QUERIES

    plan = QUERIES["daily_claim_activity"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "ts" in plan and "CartesianProduct" not in plan
