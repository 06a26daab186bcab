"""Exact top-k search by distributed histogram selection."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

LONG = 2**63 - 1


def scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond 64 bits they stop at the ends of a long."""
    if not q.size or not v.size:
        return np.zeros((len(q), len(v)), np.int64)
    most = float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1]
    if most < 2**53:
        return (q @ v.T).astype(np.int64)
    a, b = ([[int(x) for x in row] for row in m.tolist()] for m in (q, v))
    return np.array([[max(-LONG - 1, min(LONG, sum(x * y for x, y in zip(r, s, strict=True)))) for s in b] for r in a], np.int64)


def search(vectors: DataFrame, k: int = 10, query_modulus: int = 100, scale: int = 1024, query_block: int = 512, vector_block: int = 2048, bins: int = 256) -> DataFrame:
    """The k highest scores of each query: query_id, rank, vec_id, score; ties go to the smaller vec_id.

    Components become floor(scale * x). Queries are the vectors whose id is divisible by query_modulus; they go in blocks
    of query_block against blocks of vector_block, each pair scored by one matrix product. Selection is by histogram: an
    interval a query holds its k-th value; every round each pair of blocks counts its scores in `bins` parts of the
    interval (from its own k-th value upwards, since lower scores of a block can't be the k-th), the counts of all blocks
    are added, and the part with the k-th value becomes the interval, until it is one integer wide. A last pass filters
    scores above the k-th value and, at it, the smallest ids. Nothing but one interval a query is held between rounds.

    Nulls: rows with a null id, a null or empty vector, or null or non-finite components take no part. Vectors are only
    compared with those of their length. Repeated ids: all rows of a query's own id are left out of its candidates; the
    query is the smallest of its rows of each length, and each other row is a candidate. An empty table yields no rows."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("double"))
    finite = F.coalesce(F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull() & finite & (F.size("embedding") > 0))
    rows = rows.select("vec_id", x.alias("x"), F.size("embedding").alias("dim"))
    is_query = F.col("vec_id") % query_modulus == 0
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.countDistinct(F.when(is_query, F.col("vec_id"))).alias("q"))
    blocks = sizes.select("dim", F.ceil(F.col("n") / vector_block).alias("v_blocks"), F.ceil(F.col("q") / query_block).alias("q_blocks")).where("q_blocks > 0")

    def packed(df: DataFrame, n_blocks: str, as_: str) -> DataFrame:
        """Blocks of vectors by a hash of their contents."""
        dealt = df.join(blocks, "dim").withColumn(as_, F.pmod(F.xxhash64("vec_id", "x"), n_blocks))
        return dealt.groupBy("dim", as_).agg(F.sort_array(F.collect_list(F.struct("vec_id", "x"))).alias(f"{as_}_rows"), F.first("q_blocks").alias("q_blocks"))

    q = rows.where(is_query).groupBy("vec_id", "dim").agg(F.min("x").alias("x"))
    q = cut(packed(q, "q_blocks", "q").drop("q_blocks"), "queries")
    files = min(10_000, max(1, int(blocks.agg(F.sum("v_blocks")).first()[0] or 1)))  # a block is a task's work, however few bytes it has
    v = cut(packed(rows, "v_blocks", "v").repartition(files), "vectors").withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("q_blocks") - 1))).drop("q_blocks")
    pairs = v.join(q, ["dim", "q"])
    columns = pairs.columns

    def scored(row: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Query ids, candidate ids in ascending order, scores, and which of them count."""
        (qi, qx), (vi, vx) = (([r["vec_id"] for r in row[c]], np.array([r["x"] for r in row[c]], np.float64)) for c in ("q_rows", "v_rows"))
        qi, vi = np.array(qi, np.int64), np.array(vi, np.int64)
        return qi, vi, scores(qx, vx), qi[:, None] != vi[None, :]

    def limits(batches):
        for pdf in batches:
            for _, row in pdf.iterrows():
                qi, _, s, free = scored(row)
                has = free.any(1)
                lo, hi = np.where(free, s, LONG).min(1), np.where(free, s, -LONG - 1).max(1)
                yield pd.DataFrame({"query_id": qi[has], "lo": lo[has], "hi": hi[has], "n": free.sum(1)[has], "dim": row["dim"], "q": row["q"]})

    def per_query(batches, what):
        for pdf in batches:
            for _, row in pdf.iterrows():
                qi, vi, s, free = scored(row)
                known = {r["query_id"]: r for r in row["known"]}
                out = [what(i, known[i], ids, vals) for i, ids, vals in ((int(i), vi[f], t[f]) for i, t, f in zip(qi, s, free, strict=True)) if i in known and len(ids)]
                if out:
                    yield pd.concat(out, ignore_index=True)

    def counted(i, at, ids, vals):
        lo, hi, need = int(at["lo"]), int(at["hi"]), int(at["need"])
        inside = vals[(vals >= lo) & (vals <= hi)]
        if len(inside) > need:
            inside = inside[inside >= np.partition(inside, len(inside) - need)[len(inside) - need]]
        width = -(-(hi - lo + 1) // bins)
        part, n = np.unique([(int(x) - lo) // width for x in inside], return_counts=True)
        return pd.DataFrame({"dim": at["dim"], "query_id": i, "part": part.astype(np.int64), "n": n.astype(np.int64)})

    def chosen(i, at, ids, vals):
        above, equal = vals > int(at["lo"]), np.flatnonzero(vals == int(at["lo"]))[:k]  # ids ascend
        keep = np.concatenate((np.flatnonzero(above), equal))
        return pd.DataFrame({"query_id": i, "vec_id": ids[keep], "score": vals[keep]})

    def with_known(state: DataFrame) -> DataFrame:
        known = state.groupBy("dim", "q").agg(F.collect_list(F.struct("dim", "query_id", "lo", "hi", "need")).alias("known"))
        return pairs.join(known, ["dim", "q"]).select(*columns, "known")

    state = pairs.mapInPandas(limits, "query_id long, lo long, hi long, n long, dim int, q long")
    state = cut(state.groupBy("dim", "q", "query_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")).select("dim", "q", "query_id", "lo", "hi", F.least("n", F.lit(k).cast("long")).alias("need")), "limits")
    while not state.where("lo < hi").isEmpty():
        open_ = state.where("lo < hi")
        parts = with_known(open_).mapInPandas(lambda b: per_query(b, counted), "dim int, query_id long, part long, n long").groupBy("dim", "query_id", "part").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("dim", "query_id").orderBy(F.col("part").desc())
        at = parts.withColumn("sum", F.sum("n").over(down)).join(open_, ["dim", "query_id"]).where((F.col("sum") >= F.col("need")) & (F.col("sum") - F.col("n") < F.col("need")))
        width = F.expr(f"(hi - lo + {bins}) div {bins}")
        at = at.withColumn("low", F.col("lo") + F.col("part") * width)
        at = at.select("dim", "q", "query_id", F.col("low").alias("lo"), F.least(F.col("hi"), F.col("low") + width - 1).alias("hi"), (F.col("need") - (F.col("sum") - F.col("n"))).alias("need"))
        state = cut(at.unionByName(state.where("lo = hi")), "interval")
    best = with_known(state).mapInPandas(lambda b: per_query(b, chosen), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
