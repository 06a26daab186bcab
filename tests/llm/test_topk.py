import math

import numpy as np

from tidemark.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score long, rank int"


def brute(rows, k=10, modulus=100, scale=1024):
    ok = [(i, [math.floor(np.float64(np.float32(c)) * scale) for c in v]) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    queries = {}
    for i, v in ok:
        if i % modulus == 0 and ((i, len(v)) not in queries or v < queries[i, len(v)]):
            queries[i, len(v)] = v
    out = []
    for q in {i for i, _ in queries}:
        found = sorted((-sum(a * b for a, b in zip(x, v, strict=True)), i) for (j, n), x in queries.items() if j == q for i, v in ok if i != q and len(v) == n)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, 0, 0, 0) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in topk.search(df, **settings).select("query_id", "rank", "vec_id", "score").collect())


def test_random_vectors_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)] + [(300, rows[5][1]), (1, None), (2, []), (None, rows[0][1]), (3, [None] * 8), (4, [float("nan")] * 8), (5, [float("inf")] * 8), (800, [1.0, 2.0]), (801, [3.0, -1.0]), (600, [0.5, 9.0]), (802, [2.0, 2.0])]
    assert run(spark, rows, query_block=3, vector_block=64, bins=7) == brute(rows)
    assert run(spark, rows) == brute(rows)


def test_few_candidates_and_equal_scores(spark):
    rows = [(0, [0.0] * 4), *[(i, [0.0] * 4) for i in range(1, 40)]]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:4]) == brute(rows[:4])
    assert run(spark, rows[:1]) == []
    assert run(spark, []) == []


def test_values_beyond_doubles_are_exact():
    q, v = np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 1.0], [2.0**50, 0.0]])
    assert topk.scores(q, v).tolist() == [[2**60 + 1, topk.LONG]]
