"""Event logs to rows: topics and 32-byte data words by column expressions, without Python in the rows' way."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.amounts import data_word, uint256_text, word_address


@dataclass(frozen=True)
class Event:
    """An event: its first topic, and where each argument stands: ("topic" or "data", position, "address", "uint" or "bool")."""

    name: str
    topic0: str
    arguments: dict[str, tuple[str, int, str]]


def argument(where: str, i: int, kind: str) -> Column:
    word = F.col(f"topic{i}") if where == "topic" else data_word(F.col("data"), i)
    if kind == "address":
        return word_address(word)
    if kind == "bool":
        return F.when(word.isNotNull(), F.substring(word, -1, 1) == "1")
    return uint256_text(word)


def decode(logs: DataFrame, events: list[Event], *keep: str | Column) -> DataFrame:
    """Rows of the known events, all their arguments as columns (null where an event has none of that name). Logs of
    unknown topics go. The logs are read once, however many events there are."""
    topic, names = F.lower("topic0"), dict.fromkeys(a for e in events for a in e.arguments)
    known = logs.where(topic.isin(*[e.topic0.lower() for e in events]))

    def value(a: str) -> Column:
        """The argument of whichever event has it; events that hold it in one place share the expression."""
        places: dict[tuple[str, int, str], list[str]] = {}
        for e in events:
            if a in e.arguments:
                places.setdefault(e.arguments[a], []).append(e.topic0.lower())
        return F.coalesce(*[F.when(topic.isin(*topics), argument(*at).cast("string")) for at, topics in places.items()])

    name = F.coalesce(*[F.when(topic == e.topic0.lower(), e.name) for e in events])
    return known.select(*keep, name.alias("event_name"), *[value(a).alias(a) for a in names])


def with_context(logs: DataFrame, blocks: DataFrame, transactions: DataFrame) -> DataFrame:
    """Logs with the time of their block and the fields of their transaction: a missing block leaves the time null, a
    missing transaction has value "0", status 1 and nonce 0. Empty texts become null."""
    b = blocks.select("network", F.col("number").alias("block_number"), F.timestamp_seconds("timestamp").cast("timestamp_ntz").alias("block_timestamp")).dropDuplicates(["network", "block_number"])
    t = transactions.select("network", F.col("hash").alias("tx_hash"), F.col("from").alias("tx_from"), F.col("to").alias("tx_to"), F.col("value").alias("tx_value"), F.col("status").alias("tx_status"), F.col("nonce").alias("tx_nonce")).dropDuplicates(["network", "tx_hash"])
    joined = logs.join(b, ["network", "block_number"], "left").join(t, ["network", "tx_hash"], "left")
    defaults = {"tx_value": F.coalesce("tx_value", F.lit("0")), "tx_status": F.coalesce(F.col("tx_status").cast("long"), F.lit(1)), "tx_nonce": F.coalesce(F.col("tx_nonce").cast("long"), F.lit(0))}
    texts = {c: F.nullif(F.col(c), F.lit("")) for c, kind in joined.dtypes if kind == "string" and c not in defaults}
    return joined.withColumns(defaults | texts)
