from fractions import Fraction

import numpy as np
from helpers import documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1)):
    """Shares the whole again and again until no target is above twice its size."""
    w = [weights[i % 3] for i in range(len(sizes))]
    fixed = {}
    while True:
        left = Fraction(3 * sum(sizes), 2) - sum(fixed.values())
        open_ = [i for i in range(len(sizes)) if i not in fixed]
        total = sum(w[i] for i in open_)
        share = {i: left * w[i] / total for i in open_}
        over = [i for i in open_ if share[i] > 2 * sizes[i]]
        if not over:
            return [float(fixed.get(i, share.get(i, 0))) for i in range(len(sizes))]
        fixed |= {i: Fraction(2 * sizes[i]) for i in over}


def test_targets(spark):
    rng = np.random.default_rng(4)
    for sizes in ([], [0, 0], [7], [1, 1000, 0, 1000, 3], [10**12, 5, 10**9], *(rng.integers(0, 1000, n).tolist() for n in (4, 9, 30))):
        names = [None if i == len(sizes) - 1 else f"s{i:03}" for i in range(len(sizes))]
        df = spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, source_size long").repartition(3)
        got = {r["source"]: r["target"] for r in mixing.targets(df, (5, 2, 1), (3, 2), 2).collect()}
        want = brute_targets(sizes) if sum(sizes) else [0.0] * len(sizes)
        assert np.allclose([got[n] for n in names], want, rtol=1e-12)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 50), st.floats(0, 1)), min_size=1, max_size=40), st.integers(0, 5))
def test_settling_keeps_the_mass(rows, seed):
    rows.sort(reverse=True)
    size = np.array([s for s, _ in rows], float)
    mass = size * np.array([f for _, f in rows])
    before = mass.sum()
    got, carry = mixing.settle(mass, size, np.random.default_rng(seed))
    after = (got * size).sum() + (mass[carry] if carry >= 0 else 0)
    assert abs(before - after) < 1e-5
    assert ((got == 0) | (got == 1)).all()


def test_rounding_has_the_right_expectation():
    size, f = np.array([7.0, 5.0, 3.0, 2.0, 2.0]), np.array([0.6, 0.3, 0.5, 0.25, 0.9])
    taken = np.zeros(5)
    for seed in range(4000):
        mass = size * f
        got, carry = mixing.settle(mass, size, np.random.default_rng(seed))
        taken += got
        if carry >= 0:
            taken[carry] += mass[carry] / size[carry]
    assert np.allclose(taken / 4000, f, atol=0.03)


def tree(size, f, bucket_rows, seed):
    """What mix() does with one source, on arrays in descending size."""
    n, level, out = -(-len(size) // bucket_rows), 0, np.zeros(len(size), np.int64)
    mass, left, of = size * f, np.arange(len(size)), np.random.default_rng(1).permutation(len(size)) % n
    while True:
        residual = []
        for b in np.unique(of):
            at = np.sort(left[of == b])
            m = mass[at]
            rng = mixing.seeded(seed, level, "a", int(b))
            got, carry = mixing.settle(m, size[at], rng)
            out[at] += got
            if carry >= 0 and n == 1:
                out[at[carry]] += rng.random() * size[at[carry]] < m[carry]
            elif carry >= 0:
                mass[at[carry]] = m[carry]
                residual.append((at[carry], b))
        if n == 1:
            return out
        left, of = np.array([r for r, _ in residual]), np.array([b // mixing.FAN_IN for _, b in residual])
        n, level = -(-n // mixing.FAN_IN), level + 1


def test_each_document_is_taken_as_often_as_the_target_says():
    size = np.sort(np.random.default_rng(2).integers(1, 60, 24))[::-1].astype(float)
    for bucket_rows, mean in ((24, 6), (3, 15)):  # one bucket, and a tree of eight with three documents each
        got = np.array([tree(size, 0.37, bucket_rows, seed) for seed in range(1500)])
        assert np.allclose(got.mean(0), 0.37, atol=0.06)
        off = np.abs((got * size).sum(1) - 0.37 * size.sum())
        assert off.mean() < mean and off.max() <= 60


def test_words_taken_are_a_small_document_away_from_the_target(spark):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(["w"] * int(n))) for i, n in enumerate(np.concatenate((rng.integers(1, 40, 2000), rng.integers(200, 500, 20))))]
    df = documents(spark, rows)
    for bucket_rows in (4096, 250):
        got = mixing.mix(df, bucket_rows=bucket_rows).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
        assert all(abs(r["sum(taken)"] - r["max(target)"]) <= 40 for r in got)


def test_equal_rows_spread_over_buckets(spark):
    df = spark.createDataFrame([(1, "a b c", "s")] * 600 + [(2, "d", "t")], "doc_id long, text string, source string")
    got = mixing.mix(df, bucket_rows=16).where("doc_id = 1").collect()
    assert len(got) == 600 and abs(sum(r["taken"] for r in got) - got[0]["target"]) <= 3


def test_mix_of_a_table(spark):
    rows = [(i, " ".join(["w"] * (i % 37))) for i in range(900)] + [(None, "a b"), (3, None), (5, "w w w w w"), (5, "w w w w w")]
    df = documents(spark, rows)
    got = mixing.mix(df, bucket_rows=16).collect()
    again = mixing.mix(df.repartition(5), bucket_rows=16).collect()
    key = lambda r: str((r["doc_id"], r["source"], r["size"], r["taken"]))
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert len(got) == len(rows)
    sources = sorted({r["source"] for r in got}, key=lambda s: (s is None, s or ""))
    sizes = [sum(r["size"] for r in got if r["source"] == s) for s in sources]
    for s, n, t in zip(sources, sizes, brute_targets(sizes), strict=True):
        of = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == n and abs(r["target"] - t) < 1e-6 and r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in of)
        assert abs(sum(r["taken"] for r in of) - t) <= 37
    assert mixing.mix(empty(spark)).count() == 0


def test_mixed_rows(spark):
    df = documents(spark)
    want = {}
    for r in mixing.mix(df).collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["copies"]
    out = mixing.mixed(df)
    got = {}
    for r in out.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert out.columns == df.columns and got == {k: v for k, v in want.items() if v}
