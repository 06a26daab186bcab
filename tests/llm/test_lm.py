import collections
import math
import zlib

import numpy as np
import pytest
from helpers import documents, empty

from tidemark.llm import lm_score
from tidemark.llm.common import lower_words


def counts(rows, modulus=7, held=2):
    tokens = [(i, [*lower_words(t), None]) for i, t in rows]
    train = [w for i, w in tokens if (0 if i is None else zlib.crc32(str(i).encode())) % modulus != held]
    uni = collections.Counter(x for w in train for x in w)
    bi = collections.Counter(p for w in train for p in zip([None, *w[:-1]], w, strict=True))
    return tokens, uni, bi


def test_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "CHUNK_CHARS", 2000)
    monkeypatch.setattr(lm_score, "SHARD_ENTRIES", 300)
    w = np.tile([0.6, 0.3, 0.1], (lm_score.BUCKETS, 1))
    w[3] = [0.2, 0.5, 0.3]
    monkeypatch.setattr(lm_score, "learn_weights", lambda *a: w)
    df = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    tokens, uni, bi = counts(rows)
    n, v = sum(uni.values()), len(uni)
    want = []
    for i, ws in tokens:
        base = sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in ws)
        score = 0.0
        for p, x in zip([None, *ws[:-1]], ws, strict=True):
            l2, l1, l0 = w[int(lm_score.bucket_of(np.array([uni[p]]))[0])]
            score += math.log10(l2 * bi[p, x] / max(uni[p], 1) + l1 * uni[x] / n + l0 / (v + 1))
        want.append((-1 if i is None else i, len(ws), sum(uni[x] > 0 for x in ws), n, round(base, 6), round(score, 6)))
    got = [(-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in lm_score.score(df).collect()]
    assert sorted(got) == sorted(want)


def test_learned_weights_beat_the_base_on_held_out_text(spark, sf_dir):
    rows = lm_score.score(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_weights_are_a_distribution_and_recover_a_mixture():
    assert np.allclose(lm_score.learn_weights(np.array([], np.int64), np.array([]), 0.1).sum(1), 1)
    none = lm_score.BINS  # p(w | v) = 0: the bigram gets no weight
    w = lm_score.learn_weights(np.array([(2 * (lm_score.BINS + 1) + none) * (lm_score.BINS + 1) + 8]), np.array([1000.0]), 1e-6)
    assert np.allclose(w.sum(1), 1) and w[2, 0] < 0.01 and w[2, 1] > 0.9


def test_weights_equal_plain_expectation_maximisation():
    rng, steps, width = np.random.default_rng(5), lm_score.STEP, lm_score.BINS + 1
    n, p0 = 4000, 1e-4
    bucket = rng.choice([0, 2, 5], n)
    p2, p1 = np.where((bucket == 0) | (rng.random(n) < 0.3), 0, rng.random(n) ** 3), rng.random(n) ** 4 + 1e-9
    bins = [np.where(p > 0, np.minimum(-np.log(np.maximum(p, 1e-300)) * steps, lm_score.BINS - 1), lm_score.BINS).astype(int) for p in (p2, p1)]
    cells, count = np.unique((bucket * width + bins[0]) * width + bins[1], return_counts=True)
    got = lm_score.learn_weights(cells, count.astype(float), p0)

    def plain(rows, w, prior):
        for _ in range(60):
            total = 10 * prior
            for a, b in zip(p2[rows], p1[rows], strict=True):
                share = w * np.array([a, b, p0])
                total = total + share / share.sum()
            w = total / total.sum()
        return w

    pooled = plain(np.arange(n), np.array([0.5, 0.4, 0.1]), np.zeros(3) + 1e-7)
    unseen = np.array([0, *pooled[1:] / pooled[1:].sum()])
    for b in (0, 2, 5):
        prior = unseen if b == 0 else pooled
        assert np.allclose(got[b], plain(np.flatnonzero(bucket == b), prior, prior), atol=0.01)
    assert got[0, 0] == 0 and np.allclose(got.sum(1), 1)


def test_probabilities_after_an_unseen_word_add_up_to_one():
    assert (lm_score.learn_weights(np.array([], np.int64), np.array([]), 0.1)[0, 0]) == 0


def test_packing_round_trip():
    x = np.array([0, 1, 2**63, 5], np.uint64)
    assert (lm_score.from_planes(lm_score.planes(x), np.uint64) == x).all()
    keys = np.sort(np.random.default_rng(1).integers(0, 2**64, 100, dtype=np.uint64))
    edge = lm_score.bounds(keys, 7)
    assert edge[0] == 0 and edge[-1] == 100 and edge == sorted(edge)


def test_empty_and_untrained(spark):
    assert lm_score.score(empty(spark)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm_score.score(documents(spark, [(held, "a b"), (held, None)])).collect()
    assert sorted(x["n_tokens"] for x in r) == [1, 3] and all(x["n_known"] == 0 and x["score"] == pytest.approx(0) and x["base_score"] == pytest.approx(0) for x in r)
