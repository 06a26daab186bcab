"""Invite events with amounts taken from token transfers, and their 28 daily metrics in long form."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.series import over_days
from tidemark.plans.registry import INVITE_AMOUNTS, INVITE_COUNTS


def bounty_split(bounties: DataFrame, transfers: DataFrame) -> DataFrame:
    """Bounties with what their transaction's transfers paid to the inviter, to the invitee and to others. One who invited
    themselves is paid as inviter. Without transfers all amounts are 0.

    Bounties: tx_hash, log_index, inviter, invitee, ...; transfers: tx_hash, recipient, amount_g."""
    paid = transfers.groupBy("tx_hash", "recipient").agg(F.sum("amount_g").alias("amount"))
    t = paid.groupBy("tx_hash").agg(F.map_from_entries(F.collect_list(F.struct("recipient", "amount"))).alias("paid"), F.sum("amount").alias("total"))
    zero = F.lit(0).cast("decimal(38,18)")
    to = lambda c: F.coalesce(F.try_element_at("paid", F.coalesce(F.col(c), F.lit(""))), zero)
    rows = bounties.join(t, "tx_hash", "left").withColumns({"inviter_paid_g": to("inviter"), "total_paid_g": F.coalesce("total", zero)})
    rows = rows.withColumn("invitee_paid_g", F.when(F.col("inviter").eqNullSafe(F.col("invitee")), zero).otherwise(to("invitee")))
    rest = F.col("total_paid_g") - F.col("inviter_paid_g") - F.col("invitee_paid_g")
    return rows.withColumn("campaign_returned_g", F.greatest(zero, rest)).drop("paid", "total")


def invites_daily_long(raw: DataFrame, as_of: date, since: date | None = None) -> DataFrame:
    """Fourteen metrics of each day and their running totals (_at), on every day from the first event to yesterday.

    Running distinct counts are exact: an address counts from the first day on which it was paid. Raw: date, event,
    inviter, invitee, invite_type and four amounts."""
    joined, bounty = F.col("event") == "InviteeJoined", F.col("event") == "InviterBounty"
    kind = F.col("invite_type")
    amount = lambda c: F.coalesce(F.col(c).cast("decimal(28,8)"), F.lit(0).cast("decimal(28,8)"))
    invitee_paid, inviter_paid = bounty & (amount("invitee_paid_g") > 0), bounty & (amount("inviter_paid_g") > 0)
    rows = raw.where(F.col("date").isNotNull() & (F.col("date") < F.lit(as_of)))
    counts = rows.groupBy("date").agg(
        F.count_if(joined).alias("total_signups"), F.count_if(joined & F.coalesce(~kind.isin("campaign_code", "no_code"), F.lit(True))).alias("referral_signups"), F.count_if(joined & (kind == "campaign_code")).alias("campaign_signups"), F.count_if(joined & (kind == "no_code")).alias("nocode_signups"),
        F.count_if(bounty).alias("total_bounties_count"), F.count_if(invitee_paid).alias("invitee_bounties_count"), F.count_if(inviter_paid).alias("inviter_bounties_count"),
        *[F.sum(F.when(bounty, amount(c))).alias(n) for n, c in zip(INVITE_AMOUNTS, ("total_paid_g", "invitee_paid_g", "inviter_paid_g", "campaign_returned_g"), strict=True)],
    )
    roles = F.array(F.when(invitee_paid, F.struct(F.lit("unique_invitees").alias("role"), F.col("invitee").alias("who"))), F.when(inviter_paid, F.struct(F.lit("unique_inviters").alias("role"), F.col("inviter").alias("who"))))
    people = rows.select("date", F.explode(roles).alias("x")).where("x is not null").select("date", "x.role", "x.who")
    people = people.unionByName(people.withColumn("role", F.lit("total_unique_users"))).distinct()
    names = ["total_unique_users", "unique_invitees", "unique_inviters"]
    daily = people.groupBy("date").agg(*[F.count_if(F.col("role") == n).alias(n) for n in names])
    first = people.groupBy("role", "who").agg(F.min("date").alias("date")).groupBy("date").agg(*[F.count_if(F.col("role") == n).alias(f"new_{n}") for n in names])
    spine = rows.agg(F.min("date").alias("lo")).where("lo is not null").select(F.explode(F.sequence("lo", F.lit(as_of - timedelta(days=1)), F.expr("interval 1 day"))).alias("date"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    every = INVITE_COUNTS + INVITE_AMOUNTS
    dense = spine.join(counts, "date", "left").join(daily, "date", "left").join(first, "date", "left").select("date", *[zero(c) for c in (*every, *[f"new_{n}" for n in names])])
    w = over_days((), "date")
    out = dense.select("date", *[F.col(c).cast("double").alias(f"xdc_invites_{c}") for c in every], *[F.sum(f"new_{c}" if c in names else c).over(w).cast("double").alias(f"xdc_invites_{c}_at") for c in every])
    long = out.unpivot(["date"], [c for c in out.columns if c != "date"], "metric_key", "value")
    return long if since is None else long.where(F.col("date") >= F.lit(since))
