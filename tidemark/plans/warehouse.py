"""Staging, semantic and mart models of claims and invites. Each is a lazy DataFrame function."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.amounts import count_times, scale_raw
from tidemark.functions.dates import closed_as_of, closed_day, whole_days
from tidemark.operators.keyed import first_by
from tidemark.operators.series import cumulative_distinct, over_days
from tidemark.sources.ledger import ZERO_ADDRESS

INVITEE_BONUS, CAMPAIGN_NOTIONAL = 500, 1000
KEYS = ["network", "chain_id", "block_number", "block_timestamp", "tx_hash", "log_index"]


def stg_claims(raw: DataFrame, as_of: date, decimals: int = 2) -> DataFrame:
    """Claim events of closed days: addresses in lower case, amounts scaled."""
    return raw.where(closed_day(F.col("block_timestamp"), as_of)).select(
        *KEYS, F.lower("contract_address").alias("contract_address"), F.lower("claimer").alias("claimer_address"), F.col("amount").alias("amount_raw"), scale_raw(F.col("amount"), decimals).alias("amount_g"), "ingested_at"
    )


def stg_invites(raw: DataFrame, as_of: date) -> DataFrame:
    lowered = [F.lower(a).alias(b) for a, b in (("contract_address", "contract_address"), ("inviter", "inviter_address"), ("invitee", "invitee_address"))]
    return raw.where(closed_day(F.col("block_timestamp"), as_of)).select(*KEYS, "event_name", *lowered, "inviter_level", "bounty_paid", "earned_level", "ingested_at")


def claim_events(staged: DataFrame) -> DataFrame:
    """The stable name that marts read."""
    return staged.select(*KEYS, "contract_address", "claimer_address", "amount_raw", "amount_g", "ingested_at")


def claimer_activity(claims: DataFrame) -> DataFrame:
    return claims.groupBy("claimer_address", "network").agg(
        F.any_value("chain_id", True).alias("chain_id"), F.min("block_timestamp").alias("first_claim_timestamp"), F.max("block_timestamp").alias("latest_claim_timestamp"),
        F.count("*").alias("total_claims"), F.try_sum("amount_g").alias("total_amount_g"), F.countDistinct(F.to_date("block_timestamp")).alias("active_days"),
    )


def invite_signups(staged: DataFrame) -> DataFrame:
    """Signups by type: the zero address means no code, the contract itself a campaign, anyone else a referral."""
    inviter, contract = F.col("inviter_address"), F.col("contract_address")
    none, own = inviter == ZERO_ADDRESS, inviter == contract
    return staged.where("event_name = 'InviteeJoined'").select(
        *KEYS, F.col("invitee_address").alias("user_address"), F.when(none | own, None).otherwise(inviter).alias("inviter_address"),
        F.when(none, "no_code").when(own, "campaign").otherwise("referral").alias("signup_type"), F.col("inviter_level").try_cast("long").alias("inviter_level"), "ingested_at",
    )


def invite_payouts(staged: DataFrame, decimals: int = 18) -> DataFrame:
    """Payouts in tokens. A campaign's has no inviter share: null, not 0."""
    own = F.col("inviter_address") == F.col("contract_address")
    bounty, bonus = scale_raw(F.col("bounty_paid"), decimals), F.lit(INVITEE_BONUS).cast("decimal(37,18)")
    return staged.where("event_name = 'InviterBounty'").select(
        *KEYS, "invitee_address", F.when(own, None).otherwise(F.col("inviter_address")).alias("inviter_address"), F.when(own, "campaign").otherwise("referral").alias("payout_origin"),
        bonus.alias("invitee_amount_g"), F.when(own, None).otherwise(bounty).alias("inviter_amount_g"), F.when(own, bonus).otherwise(bounty + bonus).alias("total_amount_g"),
        F.col("inviter_level").try_cast("long").alias("inviter_level"), "earned_level", "ingested_at",
    )


def invitee_lifecycle(signups: DataFrame, claims: DataFrame, payouts: DataFrame) -> DataFrame:
    """One row an invitee: first signup, claims after it, first payout, claims after that.

    The claims of an invitee are joined once; claims on the invite's network, on all, and in the windows after the payout
    are conditional aggregates of that join. Ties on time go by block and log."""
    order = ["block_timestamp", "block_number", "log_index"]
    s = first_by(signups.where(F.col("signup_type").isin("referral", "campaign")), ["user_address"], order).select(
        F.col("user_address").alias("invitee_address"), "inviter_address", "signup_type", F.col("network").alias("signup_network"), F.col("chain_id").alias("signup_chain_id"), F.col("tx_hash").alias("signup_tx_hash"), F.col("block_timestamp").alias("signup_timestamp"))
    p = first_by(payouts, ["invitee_address"], order).select("invitee_address", F.col("tx_hash").alias("bounty_tx_hash"), F.col("block_timestamp").alias("bounty_timestamp"), F.col("total_amount_g").alias("bounty_total_amount_g"))
    sp = s.join(p, "invitee_address", "left")
    c = claims.select(F.col("claimer_address").alias("invitee_address"), F.col("network").alias("claim_network"), F.col("block_timestamp").alias("at"))
    joined = sp.select("invitee_address", "signup_network", "signup_timestamp", "bounty_timestamp").join(c, "invitee_address")
    after, same, paid = F.col("at") > F.col("signup_timestamp"), F.col("claim_network") == F.col("signup_network"), F.col("bounty_timestamp")
    within = lambda days: F.count_if(same & (F.col("at") > paid) & (F.col("at") <= paid + F.expr(f"interval {days} days")))
    counts = joined.groupBy("invitee_address").agg(
        F.min(F.when(after & same, F.col("at"))).alias("first_claim_timestamp"), F.max(F.when(after & same, F.col("at"))).alias("latest_claim_timestamp"),
        F.count_if(after & same).alias("same"), F.count_if(after).alias("every"), within(7).alias("d7"), within(30).alias("d30"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    has_payout = F.col("bounty_tx_hash").isNotNull()
    return sp.join(counts, "invitee_address", "left").select(
        "invitee_address", "inviter_address", "signup_type", "signup_network", "signup_chain_id", "signup_tx_hash", "signup_timestamp", "first_claim_timestamp", "latest_claim_timestamp",
        zero(F.col("same")).alias("total_claims_on_invite_network"), zero(F.col("every")).alias("total_claims_all_networks"), "bounty_tx_hash", "bounty_timestamp", "bounty_total_amount_g",
        F.when(has_payout, zero(F.col("d7"))).alias("post_payout_claims_7d"), F.when(has_payout, zero(F.col("d30"))).alias("post_payout_claims_30d"),
    )


def daily_claim_activity(claims: DataFrame) -> DataFrame:
    """Claims by day and network with running totals. The running unique count adds daily uniques; exact_cumulative_claimers
    counts each claimer once."""
    daily = claims.groupBy(F.to_date("block_timestamp").alias("metric_date"), "network").agg(
        F.count("*").alias("daily_claims"), F.countDistinct("claimer_address").alias("daily_unique_claimers"), F.sum("amount_g").alias("daily_total_g_claimed"), F.count("amount_g").alias("n"))
    w = over_days(("network",), "metric_date")
    return daily.select(
        "metric_date", "network", "daily_claims", "daily_unique_claimers", "daily_total_g_claimed", (F.col("daily_total_g_claimed").cast("double") / F.nullif(F.col("n"), F.lit(0))).alias("avg_claim_amount_g"),
        F.sum("daily_claims").over(w).alias("cumulative_claims"), F.sum("daily_unique_claimers").over(w).alias("cumulative_unique_claimers_approx"), F.sum("daily_total_g_claimed").over(w).alias("cumulative_total_g_claimed"),
    )


def exact_cumulative_claimers(claims: DataFrame) -> DataFrame:
    rows = claims.select("network", F.to_date("block_timestamp").alias("metric_date"), "claimer_address")
    return cumulative_distinct(rows, "metric_date", "claimer_address", "cumulative_unique_claimers", ("network",))


def daily_invite_metrics(signups: DataFrame, payouts: DataFrame) -> DataFrame:
    """Invite counts and amounts by day and network, 16 daily and 8 running. Days without either kind have no row."""
    day = F.to_date("block_timestamp").alias("metric_date")
    kind, origin = F.col("signup_type"), F.col("payout_origin")
    users = lambda k: F.countDistinct(F.when(kind == k, F.col("user_address")))
    s = signups.groupBy(day, "network").agg(
        F.count("*").alias("total_signups"), *[F.count_if(kind == k).alias(f"{k}_signups") for k in ("referral", "campaign", "no_code")],
        users("no_code").alias("unique_inviters_joined"), users("referral").alias("unique_referral_invitees"), users("campaign").alias("unique_campaign_invitees"),
    )
    zero = F.lit(0).cast("decimal(37,18)")
    p = payouts.groupBy(day, "network").agg(
        F.count("*").alias("total_bounties"), F.count_if(origin == "referral").alias("referral_bounties"), F.count_if(origin == "campaign").alias("campaign_bounties"), F.sum("total_amount_g").alias("total_expenditure_g"),
        F.sum("invitee_amount_g").alias("paid_to_invitees_g"), F.sum(F.coalesce("inviter_amount_g", zero)).alias("paid_to_inviters_g"), F.countDistinct("invitee_address").alias("unique_invitees_paid"),
        F.countDistinct(F.when(origin == "referral", F.col("inviter_address"))).alias("unique_inviters_paid"),
    ).withColumn("notional_campaign_retained_g", count_times(F.col("campaign_bounties"), CAMPAIGN_NOTIONAL))
    counts = ["total_signups", "referral_signups", "campaign_signups", "no_code_signups", "unique_inviters_joined", "unique_referral_invitees", "unique_campaign_invitees", "total_bounties", "referral_bounties", "campaign_bounties"]
    amounts = ["total_expenditure_g", "paid_to_invitees_g", "paid_to_inviters_g", "notional_campaign_retained_g"]
    last = ["unique_invitees_paid", "unique_inviters_paid"]
    both = s.join(p, ["metric_date", "network"], "full")
    both = both.select("metric_date", "network", *[F.coalesce(c, F.lit(0)).alias(f"daily_{c}") for c in counts], *[F.coalesce(c, zero).alias(f"daily_{c}") for c in amounts], *[F.coalesce(c, F.lit(0)).alias(f"daily_{c}") for c in last])
    w = over_days(("network",), "metric_date")
    running = ["total_signups", "referral_signups", "campaign_signups", "no_code_signups", "total_bounties", "total_expenditure_g", "paid_to_invitees_g", "paid_to_inviters_g"]
    return both.select("*", *[F.sum(f"daily_{c}").over(w).alias(f"cumulative_{c}") for c in running])


#: Labels of the funnel's stages (fixed values).
FUNNEL = ["Signed Up as Invitee", "Claimed at Least Once (Invite Chain)", "Claimed at Least Twice (Invite Chain)", "Claimed 3+ Times (Invite Chain)", "Met Eligibility Criteria (3 claims + 7 days)", "Bounty Paid"]


def invite_funnel(lifecycle: DataFrame, as_of: date) -> DataFrame:
    """Six stages from one aggregation, unpivoted."""
    claims, age = F.col("total_claims_on_invite_network"), whole_days(F.lit(closed_as_of(as_of)).cast("timestamp_ntz"), F.col("signup_timestamp"))
    one = lifecycle.agg(F.count("*").alias("n1"), *[F.count_if(claims >= i).alias(f"n{i + 1}") for i in (1, 2, 3)], F.count_if((claims >= 3) & (age >= 7)).alias("n5"), F.count_if(F.col("bounty_tx_hash").isNotNull()).alias("n6"))
    rows = one.select(F.expr("stack(6, " + ", ".join(f"{i + 1}, '{x}', n{i + 1}" for i, x in enumerate(FUNNEL)) + ") as (stage_order, stage_label, user_count)"))
    top = F.max("user_count").over(Window.partitionBy())
    return rows.select(F.lit(closed_as_of(as_of)).cast("timestamp_ntz").alias("snapshot_timestamp"), F.lit("invite_funnel").alias("funnel_name"), "stage_order", "stage_label", "user_count", F.round(F.try_divide(F.col("user_count").cast("double"), top) * 100, 2).alias("pct_of_top"))
