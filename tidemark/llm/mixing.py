"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, cut

FAN_IN = 32
#: The table of sources is broadcast up to so many (under 1 MB); with more, Spark joins by shuffle.
BROADCAST_SOURCES = 10_000


def ranked(sums: DataFrame) -> DataFrame:
    """sums with place, the number of its source by code point, null last, from 0: rows are sorted by ranges, and a range
    knows only how many rows the ranges before it have."""
    order = F.col("source").asc_nulls_last()
    ranges = cut(sums.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "source-ranges")
    before, n = [], 0
    for r in ranges.groupBy("range").count().orderBy("range").collect():  # one row a partition
        before.append((r["range"], n))
        n += r["count"]
    before = sums.sparkSession.createDataFrame(before, "range int, before long")
    nth = F.row_number().over(Window.partitionBy("range").orderBy(order))
    return ranges.join(F.broadcast(before), "range").withColumn("place", F.col("before") + nth - 1).drop("range", "before")


def targets(sums: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int) -> DataFrame:
    """sums (source, source_size, ...) with target: the weights repeat along the sources and share share[0]/share[1] of all
    sizes; a target stops at `most` times its source's size and the excess is shared anew by weight.

    A round finds the sources that are full at the present share of a unit of weight, which only grows. The driver holds
    three sums a round, however many sources there are."""
    size = F.col("source_size").cast("decimal(20,0)")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = cut(ranked(sums).withColumn("weight", w.cast("long")), "sources")
    total = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(size > 0, F.col("weight"))), F.lit(0)).alias("w")).first()
    left, open_weight, n_full = share[0] * total["n"], total["w"], 0  # left is in units of 1 / share[1]
    while True:
        full = F.col("weight") * F.lit(Decimal(left)) > size * F.lit(Decimal(most * share[1] * open_weight))
        got = rows.where((size > 0) & full).agg(F.count("*").alias("rows"), F.coalesce(F.sum("source_size"), F.lit(0)).alias("n"), F.coalesce(F.sum("weight"), F.lit(0)).alias("w")).first()
        if got["rows"] == n_full:
            break
        n_full, left, open_weight = got["rows"], share[0] * total["n"] - most * share[1] * got["n"], total["w"] - got["w"]
    open_target = F.col("weight").cast("double") * float(left) / float(max(share[1] * open_weight, 1))
    return rows.withColumn("target", F.when(size == 0, 0.0).when(full, most * F.col("source_size").cast("double")).otherwise(open_target)).drop("place", "weight")


def settle(mass: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """Pivotal rounding of rows in descending size, mass of size words each. A row is paired with the pool of all smaller
    ones that aren't settled: words move from the one to the other at random, so that the expectation of each and the
    sum of all stay, until the row is at 0 or at its whole size, or else the pool has no more room. Rows of the pool share
    what moves by their room (the less of mass and size - mass), which is the same in both directions.

    Returns 1 or 0 for settled rows and the position of the row that is left, -1 for none; its mass is then in `mass`.
    Large rows settle against many small ones, so the row that is left is as a rule one of the smallest."""

    def snap(i: int) -> None:
        m, s = mass[i:], size[i:]
        m[m <= 1e-9 * s] = 0.0
        np.copyto(m, s, where=m >= (1 - 1e-9) * s)

    carry = -1
    snap(0)
    for i in range(len(mass)):
        while carry < 0 and 0 < mass[i] < size[i]:
            pool = mass[i + 1 :]
            room = np.minimum(pool, size[i + 1 :] - pool)
            total = room.sum()
            if not total:
                carry = i
                break
            able = room > 0
            gives, takes = (total * (x[able] / room[able]).min() for x in (pool, size[i + 1 :] - pool))
            up, down = min(size[i] - mass[i], gives), min(mass[i], takes)  # what can go to the row, and from it
            d = up if rng.random() * (up + down) < down else -down
            mass[i] += d
            pool -= room * (d / total)
            snap(i)
    return (mass >= size).astype(np.int64) * (size > 0), carry


def seeded(seed: int, level: int, source: str | None, node: int) -> np.random.Generator:
    return np.random.default_rng(xxhash.xxh3_64_intdigest(repr((seed, level, source, node)).encode()))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: tuple[int, int] = (3, 2), most: int = 2, seed: int = 9, bucket_rows: int = 4096) -> DataFrame:
    """How often the mix takes each document: doc_id, source, size, source_size, target, copies, taken, row_key (a hash of
    all columns of docs).

    A source's documents all ask for target / source_size copies. The whole part is given; the fractional parts are
    rounded by the pivotal method on word mass (see settle()) in buckets of (source, hash of the row). One residual
    document a bucket goes up a reduction tree of fan-in 32, in which residuals are settled alike, until one is left a
    source, which is drawn with the probability that it has left. The words of a source therefore stay at its target but
    for that last document, one of the smallest unless a few large ones make up most of a bucket, and each document is
    taken target / source_size times in expectation, at every size alike. All draws come from seeds of (source, level,
    node) and buckets from row contents and, of equal rows, a number among them: reruns agree, whatever the partitions,
    and equal rows spread over buckets.

    Nulls: a null text has size 0; a null source is a source of its own, last in order; a null doc_id is kept. Size 0
    is taken 0 times (copies 0). Repeated rows are documents of their own. An empty table yields no rows. Very long texts
    are counted whole."""
    n_words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", n_words.alias("size"), F.xxhash64(*docs.columns).alias("row_key"))
    rows = cut(rows, "sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    plan = cut(targets(sums, weights, share, most).withColumn("buckets", F.ceil(F.col("rows") / bucket_rows)).drop("rows"), "targets")
    known = plan.agg(F.count("*").alias("n"), F.max("buckets").alias("most")).first()
    buckets = known["most"] or 1
    each = rows.groupBy(*rows.columns).agg(F.count("*").alias("equal")).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "equal"))).drop("equal").alias("r")
    rows = each.join((F.broadcast(plan) if known["n"] <= BROADCAST_SOURCES else plan).alias("p"), F.col("r.source").eqNullSafe(F.col("p.source"))).select("r.*", "source_size", "target", "buckets")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "row_key", "nth"), "buckets")).withColumns({"copies": F.lit(0).cast("long"), "mass": F.lit(None).cast("double")})

    def round_up_the_tree(level: int):
        def work(pdf: pd.DataFrame) -> pd.DataFrame:
            last = pdf["buckets"].iat[0] == 1  # of its source
            source = None if pd.isna(pdf["source"].iat[0]) else pdf["source"].iat[0]
            pdf = pdf.sort_values(["size", "doc_id", "row_key", "nth"], ascending=[False, True, True, True], kind="stable", na_position="last").reset_index(drop=True)
            size = pdf["size"].to_numpy(np.float64)
            if level == 0:
                f = np.where(size > 0, (pdf["target"] / pdf["source_size"].where(pdf["source_size"] > 0, 1)).to_numpy(), 0.0)
                whole = np.minimum(np.floor(f), most)
                pdf["copies"] = whole.astype(np.int64)
                mass = (f - whole) * size
            else:
                mass = pdf["mass"].to_numpy(np.float64).copy()
            rng = seeded(seed, level, source, int(pdf["bucket"].iat[0]))
            got, carry = settle(mass, size, rng)
            pdf["copies"] += got
            pdf["mass"] = np.nan
            if carry >= 0:
                if last:
                    pdf.loc[carry, "copies"] += int(rng.random() * size[carry] < mass[carry])
                else:
                    pdf.loc[carry, "mass"] = mass[carry]
            return pdf.astype({"doc_id": "Int64", "copies": "int64"})

        return work

    level, done = 0, None
    while True:
        got = rows.groupBy("source", "bucket").applyInPandas(round_up_the_tree(level), rows.schema)
        settled = F.col("mass").isNull() | F.isnan("mass")
        if buckets > 1:
            got = cut(got, f"mix-{level}")
        done = got.where(settled) if done is None else done.unionByName(got.where(settled))
        if buckets == 1:
            break
        rows = got.where(~settled).withColumns({"bucket": F.floor(F.col("bucket") / FAN_IN).cast("long"), "buckets": F.ceil(F.col("buckets") / FAN_IN).cast("long")})
        level, buckets = level + 1, -(-buckets // FAN_IN)
    return done.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "row_key")


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs, all columns, each as often as mix() takes it; nulls and repeated rows as there: equal rows are
    taken as often as all of them together. An empty table yields no rows."""
    copies = mix(docs, **settings).groupBy("doc_id", "row_key").agg(F.sum("copies").alias("__copies"), F.count("*").alias("__rows"))
    copies = cut(copies.withColumnsRenamed({"doc_id": "__id", "row_key": "__key"}), "copies")
    rows = docs.withColumn("__row", F.xxhash64(*docs.columns))
    if not copies.where("__rows > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id", "__row"])  # the copies of equal rows are summed
    taken = rows.join(copies.where("__copies > 0"), F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__key")))
    return taken.withColumn("__nth", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(*docs.columns)
