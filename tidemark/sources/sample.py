"""Ledger inputs derived from the benchmark tables (events, orders, lineitem, ...), for queries and tests."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.amounts import scale_number
from tidemark.sources.ledger import ZERO_ADDRESS

#: The day after the last one of each table: nothing here reads a clock.
AS_OF, LEDGER_AS_OF = date(2024, 1, 31), date(2001, 8, 2)
LEDGER_NOW = datetime(2001, 8, 1, 12)
UBI, INVITES, FAUCET, OTP, CLAIM = "0xubi", "0xinvites", "c7", "otp", "claim"
REGISTRY_CONTRACT = "0xidentity"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("long")
    network = F.element_at(F.array(F.lit("celo"), F.lit("xdc"), F.lit("fuse")), (F.col("user_id") % 3 + 1).cast("int"))
    e = read(spark, sf_dir, "events").withColumn("k", k)
    return e.select(
        network.alias("network"), F.element_at(F.array(F.lit(42220), F.lit(50), F.lit(122)), (F.col("user_id") % 3 + 1).cast("int")).cast("long").alias("chain_id"),
        F.col("event_id").alias("block_number"), F.col("ts").alias("block_timestamp"), F.concat(F.lit("0x"), F.col("event_id")).alias("tx_hash"), (F.col("event_id") % 7).alias("log_index"),
        F.concat(F.lit("0xW"), F.col("user_id"), F.lit("-"), F.col("k") % 10).alias("wallet"), F.round(F.col("value") * 100).cast("long").alias("cents"), "event_type", "k", (F.col("ts") + F.expr("interval 1 hour")).alias("ingested_at"),
    )


def claims_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).where(F.col("event_type").isin("view", "click"))
    contract = F.when(F.col("k") % 10 == 9, "0xOTHER").otherwise("0xUBI")
    return e.select("network", "chain_id", "block_number", "block_timestamp", "tx_hash", "log_index", contract.alias("contract_address"), F.lit("UBIClaimed").alias("event_name"), "ingested_at", F.col("wallet").alias("claimer"), F.col("cents").cast("string").alias("amount"))


def invites_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).where(F.col("event_type").isin("signup", "purchase"))
    code = F.floor(F.col("k") / 10)
    inviter = F.when(code == 0, ZERO_ADDRESS).when(code == 1, "0xInvites").otherwise(F.concat(F.lit("0xREF"), code.cast("string")))
    return e.select(
        "network", "chain_id", "block_number", "block_timestamp", "tx_hash", "log_index", F.lit("0xINVITES").alias("contract_address"), F.when(F.col("event_type") == "signup", "InviteeJoined").otherwise("InviterBounty").alias("event_name"),
        "ingested_at", inviter.alias("inviter"), F.col("wallet").alias("invitee"), F.concat(F.col("cents").cast("string"), F.lit("0" * 16)).alias("bounty_paid"), F.when(F.col("k") % 5 == 4, "x").otherwise((F.col("k") % 5).cast("string")).alias("inviter_level"), (F.col("k") % 2 == 0).alias("earned_level"),
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims as dashboards read them: addresses in lower case, amounts scaled."""
    return claims_raw(spark, sf_dir).select("network", F.lower("contract_address").alias("contract_address"), F.lower("claimer").alias("claimer"), "block_timestamp", scale_number(F.col("amount"), 2).alias("amount_g"))


def event_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price a day from purchases, none on every fourth day of the month; four decimals."""
    e = events(spark, sf_dir).where("event_type = 'purchase'").withColumn("day", F.to_date("block_timestamp"))
    mean = F.floor(F.sum("cents").cast("double") / F.count("cents") * 100) / 10000
    return e.where(F.dayofmonth("day") % 4 != 0).groupBy("day").agg(mean.alias("price"))


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, l = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    first = F.col("l_linenumber") == 1
    sender = F.when(first & (F.col("o_orderpriority") == "1-URGENT"), OTP).when(first & (F.col("o_orderpriority") == "2-HIGH"), CLAIM).otherwise(F.concat(F.lit("c"), F.col("o_custkey") % 120))
    recipient = F.when(F.col("l_suppkey") % 20 == 0, ZERO_ADDRESS).otherwise(F.concat(F.lit("c"), F.col("l_suppkey")))
    return o.join(l, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.concat(F.lit("0x"), F.col("o_orderkey")).alias("tx_hash"), F.col("o_orderdate").alias("ts"), sender.alias("sender"), recipient.alias("recipient"), scale_number(F.round(F.col("l_extendedprice") * 100).cast("long"), 2).alias("amount_g")
    )


def withdrawals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return o.select(F.concat(F.lit("0x"), F.col("o_orderkey")).alias("tx_hash"), F.col("o_orderdate").alias("ts"), scale_number(F.round(F.col("o_totalprice") * 100).cast("long"), 2).alias("amount_g"))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").where("s_suppkey % 10 = 3").select(F.concat(F.lit("c"), F.col("s_suppkey")).alias("address"))


def whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").where("c_mktsegment in ('BUILDING', 'FURNITURE')")
    at = F.date_add(F.lit(date(1995, 1, 1)), (F.col("c_custkey") * 7 % 2405).cast("int")).cast("timestamp_ntz")
    return c.select(F.concat(F.lit("c"), F.col("c_custkey")).alias("account"), at.alias("ts"), F.lit(REGISTRY_CONTRACT).alias("contract_address"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0")
    return s.select(F.concat(F.lit("c"), F.col("s_suppkey")).alias("address"), F.when(F.col("s_suppkey") % 4 == 0, F.col("s_nationkey")).cast("long").alias("owner_key"), F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")).alias("contract_name"), F.lit("owner").alias("account_owner"))


def owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("owner_key"), F.col("n_name").alias("name"))


def manual_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("c2", "Payments"), ("c11", "Bridge"), ("c16", "Pool")], "address string, name string")


def ledger_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price for most days from line items; none where the day of the month is a multiple of 7."""
    l = read(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate")).where(F.dayofmonth("day") % 7 != 0)
    mean = F.floor(F.sum(F.round(F.col("l_discount") * 100).cast("long")).cast("double") / F.count("*") * 100) / 10000
    return l.groupBy("day").agg(mean.alias("price"))


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    call = F.when(F.col("o_orderpriority") == "1-URGENT", None).when(F.col("o_orderpriority") == "2-HIGH", "delegatecall").when(F.col("o_orderpriority") == "5-LOW", "staticcall").otherwise("call")
    amount = F.when(F.col("o_orderkey") % 11 == 0, F.lit(0)).otherwise(F.round(F.col("o_totalprice") * 100).cast("long"))
    ts = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    return o.select(ts.alias("ts"), F.when(F.col("o_custkey") % 2 == 0, FAUCET).otherwise("c8").alias("sender"), F.concat(F.lit("0xw"), F.col("o_custkey") % 150, F.lit("-"), F.col("o_orderkey") % 10).alias("recipient"), scale_number(amount, 2).alias("amount_g"), (F.col("o_orderstatus") != "F").alias("success"), call.alias("call_type"))


def ledger_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims in the time of the orders, for queries that need both."""
    o = read(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    return o.select(F.col("o_orderdate").alias("block_timestamp"), F.concat(F.lit("0xw"), F.col("o_custkey") % 150, F.lit("-"), F.col("o_orderkey") % 7).alias("claimer"), F.when(F.col("o_orderkey") % 5 == 0, "0xother").otherwise(UBI).alias("contract_address"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("ts"), (F.col("l_returnflag") != "R").alias("success"))


def metric_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched facts: activity, amounts, prices, supplies and reserves by chain and day."""
    e = events(spark, sf_dir).withColumn("date", F.to_date("block_timestamp")).where(F.col("block_timestamp") < F.lit(AS_OF).cast("timestamp_ntz"))
    wallet = F.col("wallet")
    kind, day = F.col("event_type"), F.dayofmonth("date")
    claim = kind.isin("view", "click")
    cents = lambda c: F.sum(F.when(c, F.col("cents")))
    base = e.groupBy("date", "network").agg(
        F.countDistinct(F.when(claim, F.col("wallet"))).alias("dau"), cents(claim).alias("claimed"), cents(kind == "purchase").alias("bought"), F.count_if(kind == "purchase").alias("purchases"),
        *[cents(kind == k).alias(k) for k in ("error", "signup", "view")],
    )
    metrics = {
        "dau": F.when(F.col("dau") > 0, F.col("dau").cast("double")), "gd_claimed_1d": F.col("claimed") / 100, "p2p_gd_amount": F.when(day % 3 != 0, F.col("claimed") / 100),
        "gd_price": F.when((day % 4 != 0) & (F.col("purchases") > 0), F.floor(F.col("bought").cast("double") / F.col("purchases") * 100) / 10000), "gd_in_circulation": F.when(day % 6 != 0, F.col("error").cast("double")),
    }
    each = lambda df, named: df.select("*", F.explode(F.array(*[F.struct(F.lit(k).alias("m"), v.alias("value")) for k, v in named.items()])).alias("x")).select("*", "x.*").where("value is not null")
    first = e.where(claim).groupBy("network", "wallet").agg(F.min("date").alias("date")).groupBy("date", "network").agg(F.count("*").cast("double").alias("value")).withColumn("m", F.lit("new_claimers"))
    every = each(base, metrics).select("date", "network", "m", "value").unionByName(first).where("network <> 'fuse' or m = 'gd_in_circulation'")
    every = every.select("date", F.upper("network").alias("chain"), F.concat("network", F.lit("_"), "m").alias("metric_key"), "value")
    total = base.groupBy("date").agg(*[F.sum(k).alias(k) for k in ("signup", "view", "error")])
    more = each(total, {"xdc_reserve_liquidity_usd": F.when(day % 5 != 0, F.col("signup") / 100), "eth_gd_total_supply": F.when(day % 9 != 0, F.col("view") / 100), "eth_gd_frozen_supply": F.when(day % 8 != 0, F.col("error") / 100)})
    more = more.select("date", F.when(F.startswith("m", F.lit("xdc")), "XDC").otherwise("ETH").alias("chain"), F.col("m").alias("metric_key"), "value")
    return every.unionByName(more).withColumn("source", F.lit("SAMPLE"))


def invite_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored invite events with amounts."""
    e = events(spark, sf_dir).where(F.col("event_type").isin("signup", "purchase"))
    kind = F.when(F.col("k") < 30, "no_code").when(F.col("k") < 50, "campaign_code").when(F.col("k") < 80, "referral").otherwise("")
    inviter_cents, total = F.when(F.col("k") % 4 == 0, F.lit(0)).otherwise(F.floor(F.col("cents") / 3)), F.col("cents")
    invitee_cents = F.when(F.col("k") % 6 == 0, F.lit(0)).otherwise(F.floor(F.col("cents") / 2))
    usd = lambda c: c.cast("double") / 100
    return e.select(
        F.to_date("block_timestamp").alias("date"), "block_number", "block_timestamp", "tx_hash", "log_index", F.when(F.col("event_type") == "signup", "InviteeJoined").otherwise("InviterBounty").alias("event"),
        F.concat(F.lit("0xref"), (F.col("k") % 40).cast("string")).alias("inviter"), F.lower("wallet").alias("invitee"), kind.alias("invite_type"),
        usd(inviter_cents).alias("inviter_paid_g"), usd(invitee_cents).alias("invitee_paid_g"), usd(total - inviter_cents - invitee_cents).alias("campaign_returned_g"), usd(total).alias("total_paid_g"),
    )


def bounties(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").where("o_orderpriority = '3-MEDIUM'")
    return o.select(F.concat(F.lit("0x"), F.col("o_orderkey")).alias("tx_hash"), (F.col("o_orderkey") % 5).alias("log_index"), F.concat(F.lit("c"), F.col("o_orderkey") % 100).alias("inviter"), F.concat(F.lit("c"), F.col("o_custkey") % 100).alias("invitee"))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undecoded logs: events with addresses of 20 bytes in topics and numbers in data words."""
    from tidemark.functions.amounts import address_word
    from tidemark.sources.contracts import BOUNTY, CLAIMED, JOINED

    e = events(spark, sf_dir)
    address = lambda n: F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(n)), 40, "0"))
    who, by = address_word(address(F.col("block_number") % 1000 + 1)), address_word(address(F.col("k") + 1))
    word = lambda n: F.lpad(F.lower(F.hex(n)), 64, "0")
    kind = F.col("event_type")
    claim, joined = kind.isin("view", "click"), kind == "signup"
    return e.select(
        "network", "block_number", "tx_hash", "log_index", F.lit("0xABC").alias("address"), F.when(claim, CLAIMED.topic0).when(joined, JOINED.topic0).when(kind == "purchase", BOUNTY.topic0).otherwise("0x" + "00" * 32).alias("topic0"),
        F.when(claim, who).otherwise(by).alias("topic1"), F.when(~claim, who).alias("topic2"), F.lit(None).cast("string").alias("topic3"),
        F.when(claim, F.concat(F.lit("0x"), word(F.col("cents")))).when(joined, "0x").otherwise(F.concat(F.lit("0x"), word(F.col("cents")), word(F.col("k") % 5), word((F.col("k") % 2).cast("long")))).alias("data"),
    )


def entities(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Daily, transaction and lifetime entities as an indexer gives them: numbers as text."""
    e = events(spark, sf_dir).withColumn("date", F.to_date("block_timestamp"))
    text = lambda c: c.cast("long").cast("string")
    wei = lambda c: F.concat(text(c), F.lit("0" * 16))
    day = e.groupBy("date").agg(F.countDistinct("wallet").alias("u"), F.sum("cents").alias("c"), F.count("*").alias("n"))
    daily = day.where(F.dayofmonth("date") % 5 != 0).select(F.unix_date("date").cast("string").alias("id"), F.format_number("u", 0).alias("activeUsers"), F.when(F.dayofmonth("date") % 4 != 0, text(F.col("u") / 2)).alias("newClaimers"), wei(F.col("c")).alias("totalUBIDistributed"), wei(F.col("n")).alias("quota"))
    tx = day.select((F.unix_date("date").cast("long") * 86400).cast("string").alias("id"), text(F.col("n")).alias("transactionsCountClean"), wei(F.col("c")).alias("transactionsValueClean"), F.lit(None).cast("string").alias("totalInCirculation"))
    total = day.agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
    tx = tx.unionByName(total.select(F.lit("aggregated").alias("id"), text(F.col("n")).alias("transactionsCountClean"), wei(F.col("c")).alias("transactionsValueClean"), wei(F.col("c")).alias("totalInCirculation")))
    return daily, tx, total.select(text(F.col("n")).alias("uniqueClaimers"), text(F.col("n")).alias("totalClaims"), wei(F.col("c")).alias("totalUBIDistributed"))


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What calls to contracts give, raw: supplies (that of one chain wasn't fetched), reserve balances, prices."""
    yesterday = AS_OF - timedelta(days=1)
    e = events(spark, sf_dir).withColumn("date", F.to_date("block_timestamp")).where(F.col("date") <= F.lit(yesterday))
    wei = lambda c, n: F.concat(c.cast("string"), F.lit("0" * n))
    total = e.agg(*[F.sum(F.when(F.col("event_type") == k, F.col("cents"))).alias(k) for k in ("view", "error", "click", "signup")])
    cells = [("eth_gd_frozen_supply", F.col("error").cast("string"), 2), ("fuse_gd_in_circulation", F.col("click").cast("string"), 2), ("celo_gd_in_circulation", wei(F.col("signup"), 16), 18), ("eth_gd_total_supply", F.lit(None).cast("string"), 2)]
    supplies = total.select(F.inline(F.array(*[F.struct(F.lit(k).alias("metric_key"), raw.alias("raw"), F.lit(d).alias("decimals")) for k, raw, d in cells])))
    day = e.groupBy("date").agg(F.sum(F.when(F.col("event_type") == "signup", F.col("cents"))).alias("a"), F.sum(F.when(F.col("event_type") == "error", F.col("cents"))).alias("b"), F.count("*").alias("n"))
    balances = day.select("date", F.inline(F.array(F.struct(wei(F.col("a"), 4).alias("raw"), F.lit(6).alias("decimals")), F.struct(wei(F.col("b"), 16).alias("raw"), F.lit(18).alias("decimals")))))
    return supplies, balances, day.select("date", F.concat(F.col("n") % 50 + 1, F.lit("00")).alias("raw"), F.lit(6).alias("decimals"))
