"""Peer-to-peer transfers and the contracts that users send to.

Transfers: tx_hash, ts, sender, recipient, amount_g (decimal). Withdrawals from the one-time-payment contract: tx_hash,
ts, amount_g. Prices: day, price."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keyed import anti_by, semi_by
from tidemark.operators.series import over_days, price_series, spine_of
from tidemark.plans.claims import USD, money
from tidemark.sources.ledger import ZERO_ADDRESS


@dataclass(frozen=True)
class Addresses:
    claim: str
    otp: str
    zero: str = ZERO_ADDRESS


def between_people(transfers: DataFrame, contracts: DataFrame, withdrawals: DataFrame) -> DataFrame:
    """Direct transfers: neither side is a contract, sides differ, and the transaction is no one-time-payment withdrawal.
    Comparisons with null are not true, so rows without a side go."""
    rows = transfers.where("sender <> recipient")
    for side in ("sender", "recipient"):
        rows = anti_by(rows, contracts, side, "address")
    return anti_by(rows, withdrawals, "tx_hash", "tx_hash")


def p2p_transfers(transfers: DataFrame, withdrawals: DataFrame, contracts: DataFrame, prices: DataFrame, as_of: date, days: int, fill: bool = False) -> DataFrame:
    """By day: price, transactions, amounts, senders, receivers and users of direct and one-time-payment transfers.

    Receivers add two distinct sets, users are distinct over all. fill: carry prices over days without one."""
    inside = (F.col("ts") >= F.lit(as_of - timedelta(days=days)).cast("timestamp_ntz")) & (F.col("ts") < F.lit(as_of).cast("timestamp_ntz"))
    date_ = F.to_date("ts").alias("date")
    direct = between_people(transfers.where(inside), contracts, withdrawals).select(date_, "sender", "recipient", "amount_g")
    d = direct.groupBy("date").agg(F.count("*").alias("d_tx"), F.sum("amount_g").alias("d_gd"), F.countDistinct("sender").alias("unique_senders"), F.countDistinct("recipient").alias("d_receivers"))
    w = withdrawals.where(inside).select("tx_hash", date_, "amount_g")
    o = w.groupBy("date").agg(F.count("*").alias("o_tx"), F.sum("amount_g").alias("o_gd"))
    received = w.select("tx_hash", "date").join(transfers.select("tx_hash", "recipient"), "tx_hash").select("date", "recipient")
    r = received.groupBy("date").agg(F.countDistinct("recipient").alias("o_receivers"))
    people = direct.select("date", F.explode(F.array("sender", "recipient")).alias("user")).unionByName(received.select("date", F.col("recipient").alias("user")))
    u = people.groupBy("date").agg(F.countDistinct("user").alias("unique_users"))
    days_ = spine_of(d.select("date").unionByName(o.select("date")), "date")
    p = price_series(days_, prices.select(F.col("day").alias("date"), "price"), "date", "price", fill)
    out = d.join(o, "date", "full").join(r, "date", "left").join(u, "date", "left").join(p, "date", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    amount = zero("d_gd").cast("decimal(38,2)") + zero("o_gd").cast("decimal(38,2)")
    return out.select(
        "date", F.col("price").cast("double").alias("daily_price_usd"), (zero("d_tx") + zero("o_tx")).alias("total_tx_count"), amount.cast("double").alias("total_amount_gd"),
        (money(amount) * F.col("price").cast("decimal(12,4)")).cast("double").alias("total_amount_usd"), zero("unique_senders").alias("unique_senders"), (zero("d_receivers") + zero("o_receivers")).alias("unique_receivers"), zero("unique_users").alias("unique_users"),
    )


def with_rolling(daily: DataFrame, days: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Daily totals of p2p_transfers() with their sums over the last days, on a dense spine; days between that had no
    transfer count 0."""
    sums = ["total_tx_count", "total_amount_gd", "total_amount_usd"]
    dense = spine_of(daily.select("date"), "date").join(daily.select("date", *sums), "date", "left")
    exact = lambda c: F.coalesce(F.col(c).cast("decimal(28,6)"), F.lit(0))
    return dense.select("date", *[F.sum(exact(c)).over(over_days((), "date", n - 1)).cast("double").alias(f"{c}_{n}d") for n in days for c in sums])


def lifetime_claim_p2p(transfers: DataFrame, withdrawals: DataFrame, contracts: DataFrame, whitelist: DataFrame, at: Addresses, as_of: date) -> DataFrame:
    """One row of lifetime totals of peer-to-peer transfers and claims, up to yesterday."""
    closed = F.col("ts") < F.lit(as_of).cast("timestamp_ntz")
    end = as_of - timedelta(days=1)
    ordinary = (F.col("sender") != at.zero) & (F.col("recipient") != at.zero) & (F.col("sender") != F.col("recipient"))
    t = transfers.where(closed & (F.col("amount_g") > 0) & ((F.col("sender") == at.claim) | (F.col("sender") == at.otp) | ordinary))
    w = withdrawals.where(closed)
    direct = between_people(t.where((F.col("sender") != at.otp) & ordinary), contracts, w).select("sender", "recipient", "amount_g", "ts")
    otp = w.join(t.where(F.col("sender") == at.otp).select("tx_hash", "recipient"), "tx_hash").select(F.lit(None).cast("string").alias("sender"), "recipient", "amount_g", "ts")
    p2p = direct.unionByName(otp)
    # Each transfer goes to both of its sides once: users, senders and receivers are one aggregation by address.
    sides = p2p.select(F.explode(F.array(F.struct(F.col("sender").alias("user"), F.lit(1).alias("s"), F.lit(0).alias("r")), F.struct(F.col("recipient").alias("user"), F.lit(0).alias("s"), F.lit(1).alias("r")))).alias("x")).select("x.*")
    by_user = sides.where("user is not null").groupBy("user").agg(F.max("s").alias("s"), F.max("r").alias("r"))
    users = by_user.agg(F.count("*").alias("users"), F.count_if(F.col("s") == 1).alias("senders"), F.count_if(F.col("r") == 1).alias("receivers"))
    sums = p2p.agg(F.count("*").alias("n"), F.sum("amount_g").cast("double").alias("gd"), F.min("ts").alias("p0"), F.max("ts").alias("p1"))
    claims = semi_by(t.where(F.col("sender") == at.claim), whitelist, "recipient", "account")
    recent = F.to_date("ts") >= F.lit(end - timedelta(days=365))
    c = claims.agg(F.countDistinct("recipient").alias("claimers"), F.count("*").alias("txs"), F.sum("amount_g").cast("double").alias("claimed"), F.countDistinct(F.when(recent, F.col("recipient"))).alias("last365"), F.min("ts").alias("c0"), F.max("ts").alias("c1"))
    one = sums.crossJoin(users).crossJoin(c)  # three one-row relations
    both = F.col("p0").isNotNull() & F.col("c0").isNotNull()  # an empty side leaves the dates unknown
    return one.select(
        F.when(both, F.to_date(F.greatest("p1", "c1"))).alias("end_date"), F.col("n").alias("p2p_lifetime_tx_count"), F.col("gd").alias("p2p_lifetime_gd_amount"), F.col("senders").alias("p2p_lifetime_unique_senders"), F.col("receivers").alias("p2p_lifetime_unique_receivers"),
        F.col("users").alias("p2p_lifetime_unique_users"), F.col("claimers").alias("lifetime_unique_claimers"), F.col("txs").alias("lifetime_unique_claim_txs"), F.col("claimed").alias("lifetime_claimed_gd_amount"), F.col("last365").alias("last365d_unique_claimers"), F.when(both, F.to_date(F.least("p0", "c0"))).alias("start_date"),
    )


def most_interacted_contracts(transfers: DataFrame, whitelist: DataFrame, prices: DataFrame, labels: DataFrame, owners: DataFrame, manual: DataFrame, top: int = 100, fill: bool = False) -> DataFrame:
    """The recipients outside of the whitelist to which its members sent most, with names: a manual label, else the owner's
    name, the contract's or the account's owner. The transfers are summed by recipient before names are joined."""
    rows = anti_by(semi_by(transfers, whitelist, "sender", "account"), whitelist, "recipient", "account").withColumn("day", F.to_date("ts"))
    # A day's price per recipient is joined after the sums by day, on far fewer rows.
    days_ = spine_of(transfers.select(F.to_date("ts").alias("day")), "day")
    p = price_series(days_, prices.select("day", "price"), "day", "price", fill)
    sums = rows.groupBy("recipient", "day").agg(F.sum("amount_g").alias("gd"), F.count("*").alias("n")).join(p, "day", "left")
    sums = sums.withColumn("usd", (money(F.col("gd")) * F.col("price").cast("decimal(12,4)")).cast(USD)).groupBy("recipient").agg(F.sum("gd").alias("gd"), F.sum("usd").alias("usd"), F.sum("n").alias("n"))
    distinct = rows.groupBy("recipient").agg(F.countDistinct("tx_hash").alias("tx_count"), F.countDistinct("sender").alias("unique_whitelisted_senders"))
    names = labels.join(owners, "owner_key", "left").select(F.col("address").alias("recipient"), F.coalesce("name", "contract_name", "account_owner").alias("project"))
    named = sums.join(distinct, "recipient").join(names, "recipient", "left").join(manual.select(F.col("address").alias("recipient"), F.col("name").alias("given")), "recipient", "left")
    out = named.select(
        "recipient", F.coalesce("given", "project", F.lit("(unlabeled)")).alias("project_name"), F.col("gd").cast("double").alias("total_gd_received"), F.col("usd").cast("double").alias("total_usd_received"),
        F.col("n").alias("transfer_events"), "tx_count", "unique_whitelisted_senders",
    )
    return out.orderBy(F.desc("total_gd_received"), F.desc_nulls_last("total_usd_received"), F.desc("transfer_events"), "recipient", "project_name").limit(top)
