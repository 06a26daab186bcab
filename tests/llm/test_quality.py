import itertools
import re

import numpy as np
from helpers import documents, empty, sentence
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import quality

import random


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    twice = {x for x in windows if windows.count(x) >= 2}
    covered = set(itertools.chain.from_iterable(range(i, i + 5) for i, x in enumerate(windows) if x in twice))
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)]


@settings(max_examples=400, deadline=None)
@given(st.text("ab \n\t#é ", max_size=60))
def test_counts(text):
    assert quality.counts_of(text)[:5] == brute(text)


def labelled(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        t = sentence(rng, rng.randint(20, 60)).capitalize()
        if i % 10 == 9:
            t = " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in t.split())
        rows.append((i, t))
    labels = [(i, 0 if i % 10 == 9 else 1) for i in range(240)] + [(1, None), (None, 0), (2, 1)]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")


def test_verdict_rejects_what_labels_call_bad(spark):
    docs, labels = labelled(spark)
    got = {r["doc_id"]: r for r in quality.judge(docs, labels).collect()}
    assert not any(got[i]["base_failed"] for i in range(300))
    assert [i for i in range(300) if not got[i]["kept"]] == [i for i in range(300) if i % 10 == 9]
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(300) if i % 10 != 9]


def test_base_rules_and_odd_rows(spark):
    docs, labels = documents(spark), spark.createDataFrame([], "doc_id long, quality int")
    got = quality.judge(docs, labels).collect()
    assert len(got) == docs.count()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        want = brute(text[r["doc_id"]])
        assert [r[c] for c in quality.COUNTS[:5]] == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0]) == (not r["kept"])
    assert quality.judge(empty(spark), labels).count() == 0


def path(tree, row, level=0, at=0):
    feature, cut_at, left, right, depth = tree
    if feature[at] < 0:
        return depth[at]
    return path(tree, row, level + 1, (left if row[feature[at]] <= cut_at[at] else right)[at])


def test_forest_and_threshold_equal_a_plain_version():
    rng = np.random.default_rng(1)
    c = rng.integers(20, 60, (400, len(quality.COUNTS)))
    c[:, 0], c[:, 4] = 200, 0
    bad = rng.random(400) < 0.1
    c[~bad, 2], c[~bad, 9] = 0, 0  # constant among good rows
    v = quality.Verdict([(int(not b), *r) for b, r in zip(bad, c.tolist(), strict=True)], 0.01)
    x = quality.features(c.astype(float))
    assert len(v.forest.trees) == 100 and v.forest.n == 256
    plain = [2 ** (-np.mean([path(t, row) for t in v.forest.trees]) / quality.mean_path(256)) for row in x]
    assert np.allclose(plain, v.forest.score(x))
    kept, score = v.judge(c)
    assert np.allclose(score, plain) and (kept == (score <= v.limit)).all()
    assert (~kept[~bad]).mean() <= 0.01 and (~kept[bad]).mean() > 0.9
    below = sorted(score[~bad])[int(np.ceil(0.99 * (~bad).sum())) - 1]
    assert np.isclose(v.limit, (below + min(s for s in score[bad] if s > below)) / 2)


def test_leaf_depth_is_that_of_its_rows():
    x = np.array([[0.0], [1.0], [2.0], [9.0]])
    f = quality.IsolationForest(x, np.array([0.0]), np.array([20.0]), trees=50, sample=4, limit=3)
    for tree in f.trees:
        feature, cut_at, left, right, depth = tree
        level = {0: 0}
        for i in range(len(feature)):
            if feature[i] >= 0:
                level[left[i]] = level[right[i]] = level[i] + 1
        assert max(level.values()) <= 3

        def leaf(row):
            at = 0
            while feature[at] >= 0:
                at = (left if row[0] <= cut_at[at] else right)[at]
            return at

        ends = [leaf(r) for r in x]
        assert all(np.isclose(depth[e], level[e] + quality.mean_path(ends.count(e))) for e in ends)
    assert f.score(np.array([[20.0]])) > f.score(np.array([[1.0]]))


def test_labels_of_unknown_and_repeated_ids(spark):
    docs, labels = labelled(spark)
    more = labels.unionByName(spark.createDataFrame([(10**6 + i, 0) for i in range(500)], "doc_id long, quality int"))
    key = lambda df: sorted(map(str, df.collect()))
    assert key(quality.judge(docs, labels, sample_rows=200)) == key(quality.judge(docs, more, sample_rows=200))
    twice = docs.unionByName(docs.where("doc_id < 30"))
    assert quality.judge(twice, labels).count() == 330
    clash = labels.withColumns({"text": F.lit("x"), "n_words": F.lit(1), "kept": F.lit(True)})
    assert key(quality.judge(docs, clash)) == key(quality.judge(docs, labels))


def many(spark, n, copies=0):
    """n short labelled documents of all sorts, the first ones `copies` times more; a tenth is bad and has more symbols."""
    rng = random.Random(9)
    rows = []
    for i in range(n):
        ws = [w + rng.choice(["", "", "", "7", "A", "\n", "\nab\nab"]) for w in sentence(rng, rng.randint(10, 25)).split()]
        rows.append((i, " ".join(w + rng.choice("#$%") * (rng.random() < (0.1 if i % 10 == 9 else 0.02)) for w in ws)))
    labels = spark.createDataFrame([(i, int(i % 10 != 9)) for i in range(n)], "doc_id long, quality int")
    return documents(spark, rows + rows[:50] * copies), labels


def test_threshold_comes_from_all_labelled_rows(spark):
    docs, labels = many(spark, 6500)
    got = quality.judge(docs, labels, good_loss=0.05).join(labels, "doc_id").where("not base_failed").select("anomaly", "quality", "kept").collect()
    good = sorted(r["anomaly"] for r in got if r["quality"] == 1)
    most = good[int(np.ceil(0.95 * len(good))) - 1]
    assert len(got) > 5500 and sum(not r["kept"] for r in got if r["quality"] == 1) <= 0.05 * len(good)
    limit = (most + min((r["anomaly"] for r in got if r["quality"] == 0 and r["anomaly"] > most), default=most)) / 2
    assert all(r["kept"] == (r["anomaly"] <= limit) for r in got)


def test_fit_equals_the_plain_verdict_of_all_rows(spark):
    docs, labels = many(spark, 700, copies=6)
    counts = quality.count(docs, "counts")
    rows = sorted(map(tuple, quality.labelled(counts, labels, None).select("bucket", "upto", "quality", "m", *quality.X).collect()))
    assert {r[3] for r in rows} == {1, 7}
    every = np.repeat(np.array([r[4:] for r in rows]), [r[3] for r in rows], axis=0)
    good = np.repeat(np.array([r[2] for r in rows]) == 1, [r[3] for r in rows])
    plain = quality.IsolationForest(every[good], every.min(0), every.max(0))
    got = quality.fit(counts, labels, None, 0.01).value
    assert all((a == b).all() for s, t in zip(plain.trees, got.forest.trees, strict=True) for a, b in zip(s, t, strict=True))
    score = plain.score(every)
    most = np.sort(score[good])[int(np.ceil(0.99 * good.sum())) - 1]
    assert got.limit == (most + min((s for s in score[~good] if s > most), default=most)) / 2


def test_draws_reach_every_row_and_none_twice():
    got = quality.draws(30_000, 200, 256, 6)
    assert all(len(set(d.tolist())) == 256 for d in got) and [d.tolist() for d in got] == [d.tolist() for d in quality.draws(30_000, 200, 256, 6)]
    tenths = np.bincount(np.concatenate(got) // 3000, minlength=10) / (200 * 256)
    assert len(tenths) == 10 and (abs(tenths - 0.1) < 0.01).all()
    assert [sorted(d.tolist()) for d in quality.draws(3, 2, 256, 6)] == [[0, 1, 2]] * 2


def test_rank_of_repeated_scores(spark):
    rng = np.random.default_rng(2)
    score = np.concatenate([rng.random(300), [0.5, 0.5, np.nextafter(0.5, 1), 1e-9, 1.0]])
    m = rng.integers(1, 5, len(score))
    rows = spark.createDataFrame(list(zip(m.tolist(), score.view(np.int64).tolist(), strict=True)), "m long, bits long")
    plain = np.sort(np.repeat(score, m))
    for rank in (1, 2, 77, len(plain) // 2, len(plain) - 1, len(plain)):
        assert np.int64(quality.at_rank(rows, rank)).view(np.float64) == plain[rank - 1]
