"""The ledger queries over inputs derived from the benchmark tables. Amounts leave as double, counts as long."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import urls
from tidemark.operators import checks
from tidemark.operators.keyed import dedup
from tidemark.plans import claims, entities, facts, faucet, invites, run, transfers, warehouse
from tidemark.sources import contracts, ledger, sample
from tidemark.sources.sample import AS_OF, FAUCET, LEDGER_AS_OF, LEDGER_NOW, UBI
from tidemark.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
GENESIS = {"XDC": date(2024, 1, 5)}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles."""
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")})


def staged(s: SparkSession, d: str) -> DataFrame:
    return warehouse.stg_claims(sample.claims_raw(s, d), AS_OF)


def claim_events(s: SparkSession, d: str) -> DataFrame:
    return warehouse.claim_events(staged(s, d))


def stg_invites(s: SparkSession, d: str) -> DataFrame:
    return warehouse.stg_invites(sample.invites_raw(s, d), AS_OF)


def signups(s: SparkSession, d: str) -> DataFrame:
    return warehouse.invite_signups(stg_invites(s, d))


def payouts(s: SparkSession, d: str) -> DataFrame:
    return warehouse.invite_payouts(stg_invites(s, d))


def lifecycle(s: SparkSession, d: str) -> DataFrame:
    return warehouse.invitee_lifecycle(signups(s, d), claim_events(s, d), payouts(s, d))


def build(s: SparkSession, d: str) -> DataFrame:
    return facts.facts_build(sample.metric_facts(s, d))


def stored(s: SparkSession, d: str) -> DataFrame:
    """A fact table that lacks some of a run's keys."""
    return build(s, d).where((F.dayofmonth("date") % 2 == 0) & (F.col("chain") == "XDC"))


def dq_tests(s: SparkSession, d: str) -> DataFrame:
    """The whole suite as one table of test, failures and status."""
    c, i, p = claim_events(s, d), signups(s, d), payouts(s, d)
    daily, life = warehouse.daily_claim_activity(c), lifecycle(s, d)
    tests = {
        "claim_events_not_null_network": checks.not_null(c, "network"), "claim_events_not_null_amount_g": checks.not_null(c, "amount_g"), "claim_events_unique_key": checks.unique(c, *ledger.NATURAL_KEY),
        "claim_events_accepted_network": checks.accepted_values(c, "network", ["celo", "xdc"]), "claim_events_non_negative_amount": checks.non_negative(c, "amount_g"), "claim_events_closed_days": checks.no_later_than(c, "block_timestamp", datetime(2024, 1, 31)),
        "invite_signups_accepted_type": checks.accepted_values(i, "signup_type", ["no_code", "campaign", "referral"]), "invite_payouts_reconcile": checks.reconcile(p, F.col("total_amount_g").cast("decimal(38,17)"), (F.col("invitee_amount_g") + F.coalesce("inviter_amount_g", F.lit(0))).cast("decimal(38,17)")),
        "daily_claim_activity_unique_day": checks.unique(daily, "metric_date", "network"), "invitee_unique_address": checks.unique(life, "invitee_address"), "payouts_have_signups": checks.relationship(p.select("invitee_address").distinct(), "invitee_address", i, "user_address"),
    }
    return checks.failures(tests)


def utm_build(s: SparkSession, d: str) -> DataFrame:
    p = sample.read(s, d, "pages")
    tag = urls.campaign(F.lit("Spring"), F.lit("Awareness"), F.lit(date(2024, 1, 31)), F.concat(F.lit("P"), "page_id"))
    return p.select("page_id", urls.tagged_url(F.col("url"), F.lit("Twitter"), F.lit("social  post"), tag, F.lit("")).alias("tagged"))


def utm_links(s: SparkSession, d: str) -> DataFrame:
    """Links of named campaigns: names with a hyphen, and empty ones, give none; content with one is left out."""
    p = sample.read(s, d, "pages")
    i = F.col("page_id")
    name = F.when(i % 10 < 8, F.concat(F.lit(" P "), i)).when(i % 10 == 8, F.concat(F.lit("p-"), i)).otherwise("")
    content = F.concat(F.when(i % 2 == 0, "C").otherwise("c-"), i)
    return p.select("page_id", urls.campaign_link(F.col("url"), F.lit("Twitter"), F.lit("social"), F.lit("ubi"), F.lit("awareness"), F.lit(date(2024, 1, 31)), name, content).alias("link"))


def utm_validate(s: SparkSession, d: str) -> DataFrame:
    p = sample.read(s, d, "pages").select("page_id", urls.query_value(F.col("url"), "ref").alias("ref"), urls.query_value(F.col("url"), "page").alias("page"))
    unknown = urls.unknown_values(p, "ref", ["x", "y"]).select("page_id", F.lit(False).alias("known"))
    return p.join(unknown, "page_id", "left").select("page_id", "ref", "page", F.coalesce("known", F.lit(True)).alias("known"))


def swaps(s: SparkSession, d: str) -> DataFrame:
    e = sample.events(s, d).where("event_type in ('purchase', 'view')")
    return e.select(F.to_date("block_timestamp").alias("day"), F.when(F.col("event_type") == "purchase", "in").otherwise("out").alias("direction"), F.col("cents").alias("amount"))


def sparse_dau(s: SparkSession, d: str) -> DataFrame:
    m = sample.metric_facts(s, d).where(F.endswith("metric_key", F.lit("dau")) & (F.dayofmonth("date") % 3 != 0))
    return facts.rolling_sum_nd(m.select("chain", "date", "value"), 7, ("chain",))


def health(s: SparkSession, d: str) -> DataFrame:
    """Health rows of a run: one for each metric, errors where a metric brought nothing, warnings where days lack a price."""
    rows = build(s, d).groupBy("chain", "metric_key").agg(F.count("*").alias("records_written"))
    warned = facts.price_warnings(sample.metric_facts(s, d)).groupBy("metric_key").agg(F.count("*").alias("w"))
    status = F.when(F.col("w") > 0, "warn").otherwise("ok")
    out = rows.join(warned, "metric_key", "left").select(
        F.lit("run").alias("run_id"), F.lit(AS_OF).alias("run_date"), F.lit(datetime(2024, 1, 31)).cast("timestamp").alias("started_at"), F.lit("ALL").alias("adapter"), "chain", "metric_key", status.alias("status"), "records_written",
        F.lit(30).cast("long").alias("records_expected"), F.coalesce(F.concat(F.col("w").cast("string"), F.lit(" days without price")), F.lit("")).alias("details"), F.lit(0).cast("long").alias("elapsed_ms"),
    )
    from tidemark.sources.sinks import with_summary

    return with_summary(out).withColumn("started_at", F.col("started_at").cast("timestamp_ntz"))


def p2p(s: SparkSession, d: str) -> DataFrame:
    return transfers.p2p_transfers(sample.transfers(s, d), sample.withdrawals(s, d), sample.contracts(s, d), sample.ledger_prices(s, d), LEDGER_AS_OF, 60)


def ubi(s: SparkSession, d: str) -> DataFrame:
    return claims.ubi_daily_summary(sample.claims(s, d), sample.event_prices(s, d), UBI, AS_OF, 10)


#: The supply that stands in where the first chain's explorer gives none.
SUPPLY_FALLBACK = {"eth_gd_total_supply": 900_000_000.0}


def adapters(s: SparkSession, d: str) -> list[run.Adapter]:
    """All adapters of the registry over the sample inputs."""
    upstream = run.Upstream({"p2p": lambda: p2p(s, d)})
    supplies, balances, prices = sample.snapshots(s, d)

    def tables(_: DataFrame) -> DataFrame:
        lifetime = QUERIES["lifetime_claim_p2p"](s, d)
        parts = [("active_claimers", QUERIES["active_claimers"](s, d), "day"), ("daily_claimers", QUERIES["daily_claimers"](s, d), "period_date"), ("lifetime_claim_p2p", lifetime, "end_date"), ("p2p_transfers", upstream["p2p"], "date"), ("p2p_transfers", transfers.with_rolling(upstream["p2p"]), "date"), ("ubi_daily_summary", ubi(s, d), "date")]
        out = run.nothing(s)
        for part in parts:
            out = out.unionByName(facts.table_metrics(*part))
        return out

    fetched = [
        run.Adapter("Table", tables), run.Adapter("Subgraph", lambda _: entities.entity_facts(*sample.entities(s, d), AS_OF, GENESIS["XDC"])),
        run.Adapter("Reserve", lambda _: run.reserve(sample.event_prices(s, d), swaps(s, d).withColumn("amount", F.col("amount").cast("double") / 100))),
        run.Adapter("Supply", lambda _: run.supply(supplies, AS_OF, SUPPLY_FALLBACK)), run.Adapter("XdcReserve", lambda _: run.other_reserve(prices, balances)),
        run.Adapter("XdcInvites", lambda _: run.invite_facts(invites.invites_daily_long(sample.invite_rows(s, d), AS_OF))),
    ]
    return [*fetched, run.computed_adapter(a.name for a in fetched)]


def facts_run(s: SparkSession, d: str) -> DataFrame:
    """One run of all adapters: every registered metric but those that a sample gives no input for."""
    return run.run_facts(s, adapters(s, d))[0]


def smart_backfill(s: SparkSession, d: str) -> DataFrame:
    """What a run adds to a store that lacks the odd days of its last week and some metrics altogether."""
    rows = [a for a in adapters(s, d) if a.name in ("Subgraph", "XdcReserve")]
    whole = run.run_facts(s, rows)[0]
    store = whole.where("chain = 'XDC' and metric_key <> 'xdc_gd_price' and date < date'2024-01-20'")
    return run.smart_backfill(s, store, lambda since: (whole.where(F.col("date") >= F.lit(since)), []), AS_OF, GENESIS)[0]


QUERIES: dict[str, Query] = {
    "stg_claims": lambda s, d: plain(staged(s, d)),
    "stg_invites": stg_invites,
    "claim_events": lambda s, d: plain(claim_events(s, d)),
    "claimer_activity": lambda s, d: plain(warehouse.claimer_activity(claim_events(s, d))),
    "invite_signups": signups,
    "invite_payouts": lambda s, d: plain(payouts(s, d)),
    "invitee_lifecycle": lambda s, d: plain(lifecycle(s, d)),
    "daily_claim_activity": lambda s, d: plain(warehouse.daily_claim_activity(claim_events(s, d))),
    "cumulative_claimers_exact": lambda s, d: warehouse.exact_cumulative_claimers(claim_events(s, d)),
    "daily_invite_metrics": lambda s, d: plain(warehouse.daily_invite_metrics(signups(s, d), payouts(s, d))),
    "invite_funnel": lambda s, d: warehouse.invite_funnel(lifecycle(s, d), AS_OF),
    "active_claimers": lambda s, d: claims.active_claimers(sample.claims(s, d), UBI, AS_OF, show_days=20),
    "daily_claimers": lambda s, d: claims.daily_claimers(sample.claims(s, d), UBI, AS_OF, 25),
    "ubi_daily_summary": ubi,
    "facts_tables": lambda s, d: facts.table_metrics("ubi_daily_summary", ubi(s, d)),
    "facts_entities": lambda s, d: entities.entity_facts(*sample.entities(s, d), AS_OF, GENESIS["XDC"]),
    "decode_claims": lambda s, d: contracts.claim_rows(sample.logs(s, d)),
    "decode_invites": lambda s, d: contracts.invite_rows(sample.logs(s, d)),
    "p2p_transfers": p2p,
    "p2p_rolling": lambda s, d: transfers.with_rolling(p2p(s, d)),
    "lifetime_claim_p2p": lambda s, d: transfers.lifetime_claim_p2p(sample.transfers(s, d), sample.withdrawals(s, d), sample.contracts(s, d), sample.whitelist(s, d), transfers.Addresses(sample.CLAIM, sample.OTP), LEDGER_AS_OF),
    "most_interacted_contracts": lambda s, d: transfers.most_interacted_contracts(sample.transfers(s, d), sample.whitelist(s, d), sample.ledger_prices(s, d), sample.labels(s, d), sample.owners(s, d), sample.manual_labels(s)),
    "faucet_total": lambda s, d: faucet.faucet_total(sample.traces(s, d), sample.ledger_prices(s, d), FAUCET),
    "faucet_monthly": lambda s, d: faucet.faucet_monthly(sample.traces(s, d), sample.ledger_prices(s, d), FAUCET, LEDGER_NOW),
    "faucet_runrate": lambda s, d: faucet.faucet_runrate(sample.traces(s, d), sample.ledger_prices(s, d), FAUCET, LEDGER_NOW),
    "faucet_vs_claimers": lambda s, d: faucet.faucet_vs_claimers(sample.traces(s, d), sample.ledger_claims(s, d), FAUCET, UBI, LEDGER_NOW),
    "faucet_daily": lambda s, d: faucet.faucet_daily(sample.traces(s, d), sample.ledger_prices(s, d), FAUCET, LEDGER_NOW),
    "verified_users": lambda s, d: faucet.verified_users(sample.whitelist(s, d), sample.REGISTRY_CONTRACT, LEDGER_NOW),
    "activity_share": lambda s, d: faucet.activity_share(sample.transactions(s, d), sample.traces(s, d), sample.ledger_claims(s, d), sample.transfers(s, d), FAUCET, UBI, LEDGER_NOW),
    "facts_build": build,
    "facts_agg": lambda s, d: facts.facts_agg(build(s, d)),
    "facts_run": facts_run,
    "smart_backfill": smart_backfill,
    "facts_append": lambda s, d: facts.facts_append(build(s, d), stored(s, d)),
    "rolling_sum_nd": sparse_dau,
    "returning_claimers": lambda s, d: facts.returning_claimers(sample.metric_facts(s, d)),
    "usd_computed": lambda s, d: facts.usd_computed(sample.metric_facts(s, d)),
    "price_warnings": lambda s, d: facts.price_warnings(sample.metric_facts(s, d)),
    "supply_computed": lambda s, d: facts.supply_computed(sample.metric_facts(s, d)),
    "reserve_computed": lambda s, d: facts.reserve_computed(sample.metric_facts(s, d)),
    "daily_price": lambda s, d: facts.daily_price(sample.event_prices(s, d)),
    "reserve_volume": lambda s, d: facts.reserve_volume(swaps(s, d)).withColumns({c: F.col(c).cast("double") for c in ("amount_in", "amount_out", "volume")}),
    "invites_daily_long": lambda s, d: invites.invites_daily_long(sample.invite_rows(s, d), AS_OF),
    "bounty_split": lambda s, d: plain(invites.bounty_split(sample.bounties(s, d), sample.transfers(s, d))),
    "raw_dedup": lambda s, d: dedup(sample.read(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"], ["l_partkey"]),
    "gap_report": lambda s, d: facts.gap_report(sample.metric_facts(s, d)).withColumns({c: F.col(c).cast("long") for c in ("expected_days", "missing_days")}),
    "missing_days": lambda s, d: facts.missing_days(sample.metric_facts(s, d)),
    "coverage_report": lambda s, d: facts.coverage_report(sample.metric_facts(s, d), AS_OF),
    "backfill_preview": lambda s, d: facts.backfill_preview(sample.metric_facts(s, d), AS_OF, GENESIS),
    "freshness": lambda s, d: checks.freshness(sample.claims_raw(s, d), "ingested_at", datetime(2024, 2, 1, 12)),
    "cursor": lambda s, d: ledger.cursor(claim_events(s, d)),
    "final_blocks": lambda s, d: ledger.tip(sample.events(s, d)),
    "dq_tests": dq_tests,
    "health": health,
    "utm_build": utm_build,
    "utm_links": utm_links,
    "utm_validate": utm_validate,
    "stream_ingest": ingest.sample_ingest,
}
