"""Row selection by key: first rows, anti joins, deduplication, appends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_by(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in a total order. The rank filter lets Spark keep one row a key and task before the
    shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def anti_by(df: DataFrame, other: DataFrame, left: str, right: str) -> DataFrame:
    """Rows of df whose `left` isn't a value of `right`."""
    keys = other.select(F.col(right).alias("__k"))
    return df.join(keys, df[left] == keys["__k"], "left_anti")


def semi_by(df: DataFrame, other: DataFrame, left: str, right: str) -> DataFrame:
    keys = other.select(F.col(right).alias("__k"))
    return df.join(keys, df[left] == keys["__k"], "left_semi")


def dedup(df: DataFrame, keys: list[str], order: list[Column | str] | None = None) -> DataFrame:
    """One row for each natural key: the first in order, or any."""
    return first_by(df, keys, order) if order else df.dropDuplicates(keys)


def new_keys_only(batch: DataFrame, store: DataFrame, keys: list[str], merge: bool = False) -> DataFrame:
    """What an append adds: rows whose key isn't in the store, once each. merge=True returns the whole table after an
    upsert instead: the batch's rows over the store's."""
    once = batch.dropDuplicates(keys)
    if merge:
        return once.unionByName(store.join(once.select(*keys), keys, "left_anti"))
    return once.join(store.select(*keys), keys, "left_anti")


def layered(batch: DataFrame, history: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A value for each key: the batch's, else the stored one."""
    b, h = batch.select(*keys, F.col(value).alias("__b")), history.select(*keys, F.col(value).alias("__h"))
    return b.join(h, keys, "full").select(*keys, F.coalesce("__b", "__h").alias(value))


def without(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Deletes by a short list of keys; rows with a null stay."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(values))
