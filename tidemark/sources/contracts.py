"""The events of the ledger's contracts, and raw tables from their logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keccak import topic_of
from tidemark.sources.decode import Event, decode


def event(name: str, **arguments: str) -> Event:
    """An event by its arguments in order, name="kind" or "kind indexed": topics and data words follow from that."""
    places, topics, words = {}, 1, 0
    for arg, kind in arguments.items():
        base = kind.removesuffix(" indexed")
        short = "uint" if base.startswith("uint") else base
        if kind != base:
            places[arg], topics = ("topic", topics, short), topics + 1
        else:
            places[arg], words = ("data", words, short), words + 1
    return Event(name, topic_of(f"{name}({','.join(k.removesuffix(' indexed') for k in arguments.values())})"), places)


CLAIMED = event("UBIClaimed", claimer="address indexed", amount="uint256")
#: Other events of the claim contract; pass them to decode() to enable them.
CLAIM_CONTRACT_EXTRAS = [
    event("AdminChanged", previous_admin="address", new_admin="address"), event("BeaconUpgraded", beacon="address indexed"), event("CycleLengthSet", new_cycle_length="uint256"), event("DaySet", new_day="uint256"),
    event("Initialized", version="uint8"), event("ShouldWithdrawFromDAOSet", should_withdraw="bool"), event("UBICalculated", day="uint256", daily_ubi="uint256", block="uint256"),
    event("UBICycleCalculated", day="uint256", pool="uint256", cycle_length="uint256", daily_ubi_pool="uint256"), event("Upgraded", implementation="address indexed"), event("WithdrawFromDao", prev_balance="uint256", new_balance="uint256"),
]
JOINED = event("InviteeJoined", inviter="address indexed", invitee="address indexed")
BOUNTY = event("InviterBounty", inviter="address indexed", invitee="address indexed", bounty_paid="uint256", inviter_level="uint256", earned_level="bool")
TRANSFER = event("Transfer", sender="address indexed", recipient="address indexed", value="uint256")

LOG = ["network", "block_number", "tx_hash", "log_index"]


def claim_rows(logs: DataFrame) -> DataFrame:
    return decode(logs, [CLAIMED], *LOG, F.lower("address").alias("contract_address"))


def invite_rows(logs: DataFrame) -> DataFrame:
    return decode(logs, [JOINED, BOUNTY], *LOG, F.lower("address").alias("contract_address")).withColumn("earned_level", F.col("earned_level").cast("boolean"))


def invite_records(logs: DataFrame, contract: str, token: str, decimals: int = 18) -> tuple[DataFrame, DataFrame]:
    """A mixed stream of logs, routed by (address, topic): invite events of the contract, and transfers of the token that
    the contract sent, with amounts in tokens."""
    from tidemark.functions.amounts import scale_raw

    invites = invite_rows(logs.where(F.lower("address") == contract.lower()))
    moved = decode(logs.where(F.lower("address") == token.lower()), [TRANSFER], *LOG).where(F.col("sender") == contract.lower())
    return invites, moved.select("tx_hash", "recipient", scale_raw(F.col("value"), decimals).alias("amount_g"))
