"""Facts from daily, transaction and lifetime entities of an indexer."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.amounts import scale_raw
from tidemark.functions.dates import epoch_day, unix_day
from tidemark.operators.series import rolling_sum
from tidemark.plans.facts import facts
from tidemark.plans.registry import METRICS

SOURCE = "ENTITIES"


def number(field: str, decimals: int):
    """Numbers arrive as text, with thousands separators at times; what can't be read counts 0."""
    return F.when(F.col(field).isNotNull(), F.coalesce(scale_raw(F.regexp_replace(F.col(field), ",", ""), decimals).cast("double"), F.lit(0.0)))


def of_types(*types: str):
    return [m for m in METRICS.values() if m.adapter == "Subgraph" and m.spec.get("type") in types]


def dated(entities: DataFrame, metrics, day) -> DataFrame:
    """One row for each (day, metric) of entities with a date; null fields yield none."""
    cells = [F.struct(F.lit(m.chains[0]).alias("chain"), F.lit(m.key).alias("metric_key"), number(m.spec["field"], m.spec["token_decimals"]).alias("value")) for m in metrics if m.spec["field"] in entities.columns]
    return entities.select(day.alias("date"), *[c.alias(f"c{i}") for i, c in enumerate(cells)]).select("date", F.inline(F.array(*[f"c{i}" for i in range(len(cells))]))).where("value is not null")


def rolling(rows: DataFrame, metrics) -> DataFrame:
    """Sums of the last days of a metric, dense between its first and last day."""
    out = None
    for days in sorted({m.spec["days"] for m in metrics}):
        names = {m.key: m for m in metrics if m.spec["days"] == days}
        exact = rows.where(F.col("metric_key").isin(*names)).withColumn("value", F.col("value").cast("decimal(28,8)"))
        part = rolling_sum(exact, "date", "value", days, "value", ("chain", "metric_key"))
        out = part if out is None else out.unionByName(part)
    return out.select("date", "chain", "metric_key", F.col("value").cast("double").alias("value"))


def entity_facts(daily: DataFrame, transactions: DataFrame, lifetime: DataFrame, as_of: date, genesis: date | None = None) -> DataFrame:
    """All registered metrics of these entities. Daily entities have days since 1970 as ids, transaction entities seconds
    or "aggregated" for their lifetime row; lifetime rows are dated yesterday. Days before the chain's first have none;
    rolling sums read them where they are there."""
    yesterday = F.lit(as_of - timedelta(days=1))
    by_day = transactions.where("id <> 'aggregated'")
    out = [
        dated(daily, of_types("daily_field"), unix_day(F.col("id"))),
        dated(by_day, of_types("transaction_daily"), epoch_day(F.col("id").try_cast("long"))),
        dated(transactions.where("id = 'aggregated'"), of_types("transaction_lifetime"), yesterday),
        dated(lifetime, of_types("global_total"), yesterday),
        rolling(dated(daily, of_types("rolling_sum"), unix_day(F.col("id"))), of_types("rolling_sum")),
        rolling(dated(by_day, of_types("transaction_rolling"), epoch_day(F.col("id").try_cast("long"))), of_types("transaction_rolling")),
    ]
    every = out[0]
    for rows in out[1:]:
        every = every.unionByName(rows)
    every = every.where(F.col("date") < F.lit(as_of))
    return facts(every if genesis is None else every.where(F.col("date") >= F.lit(genesis)), SOURCE)
