import collections
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import Sets, documents, empty, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import line_dedup, pairs


def brute(rows, k=8, percent=80):
    """Dropped line numbers of each (doc_id, text)."""
    occ = sorted({(i is not None, i or 0, t or "", n, x) for i, t in rows for n, x in zip(*line_dedup.normal_lines(t), strict=True)})
    sets = {x: {x[j : j + k] for j in range(max(1, len(x) - k + 1))} for *_, x in occ}
    u = Sets()
    for a, b in itertools.combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            u.join(a, b)
    return occ, {x: u.find(x) for x in sets}


def check(spark, rows):
    occ, group = brute(rows)
    got = line_dedup.line_counts(documents(spark, rows)).collect()
    assert sorted(r["n_lines"] for r in got) == sorted(len(line_dedup.normal_lines(t)[0]) for _, t in rows)
    text = dict(rows)
    kept = {}
    for r in got:
        gone = set(map(int, r["dropped"].split(","))) if r["dropped"] else set()
        assert len(gone) == r["n_dropped"]
        for n, x in zip(*line_dedup.normal_lines(text[r["doc_id"]]), strict=True):
            if n not in gone:
                kept.setdefault(group[x], set()).add((r["doc_id"] is not None, r["doc_id"] or 0, n))
    # of each component one line stays: the first
    assert kept == {g: {min((a, b, n) for a, b, _, n, x in occ if group[x] == g)} for g in set(group.values())}


def test_equals_brute_force(spark):
    check(spark, list(enumerate(texts(5, families=10, copies=6))))


def test_many_variants_of_a_line(spark):
    rng = random.Random(7)
    base = texts(6)[10].split("\n")[0] * 3
    rows = []
    for i in range(120):
        s = list(base)
        for _ in range(rng.randint(0, 6)):
            s[rng.randrange(len(s))] = rng.choice("0123456789")
        rows.append((i, "".join(s) + "\n\nown line " + str(rng.random())))
    check(spark, rows)


def test_texts_without_lines_and_repeats(spark):
    rows = [(1, "Same line here\nother"), (1, "Same line here\nother"), (2, "same  LINE here\n\nnew"), (3, None), (4, " \n"), (None, "same line here"), (5, "same line here")]
    df = documents(spark, rows)
    out = line_dedup.without_duplicate_lines(df)
    assert out.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted([(1, "other"), (1, "other"), (2, "\nnew"), (3, None), (4, " \n"), (None, "same line here")], key=str)
    assert line_dedup.line_counts(empty(spark)).count() == 0 and line_dedup.without_duplicate_lines(empty(spark)).count() == 0


def test_signatures_agree_as_often_as_sets(spark):
    rng = random.Random(1)
    a = "".join(rng.choice("abcdefghij") for _ in range(400))
    b = a[:300] + "".join(rng.choice("klmnop") for _ in range(100))
    x, y = line_dedup.signatures([a, b], 8)
    sets = [{s[i : i + 8] for i in range(393)} for s in (a, b)]
    assert abs((x == y).mean() - len(sets[0] & sets[1]) / len(sets[0] | sets[1])) < 0.2
    assert (line_dedup.signatures(["ab", "x", a], 8)[2] == x).all()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB \n\t\x1c\x85\u3000\u00e9\u0130"), max_size=30))
def test_normal_lines_by_plain_splitting(text):
    want = [(i, " ".join(x.split())) for i, x in enumerate(text.lower().split("\n")) if x.split()]
    assert list(zip(*line_dedup.normal_lines(text), strict=True)) == want


def test_shingles_are_the_same_in_any_company():
    lines = ["abcdefghijkl", "éàüabcdefgh", "abcdefghij猫klmnopqr", "猫狗鸟鱼牛羊马鸡鸭鹅", "abc", "\ud800abcdefghij"]
    for k in (8, 5):
        h, begin = line_dedup.shingles(lines, k)
        for i, x in enumerate(lines):
            assert (line_dedup.shingles([x], k)[0] == h[begin[i] : begin[i + 1]]).all()
        every = {x[j : j + k].ljust(k, "\0") for x in lines for j in range(max(1, len(x) - k + 1))}
        assert len(set(h.tolist())) == len(every)
    assert set(line_dedup.shingles(["abcdefghij"], 8)[0].tolist()) <= set(line_dedup.shingles([lines[2]], 8)[0].tolist())


def test_packed_band_keys_find_the_shared_ones(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "CHUNK_LINES", 7)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 50)
    rng = random.Random(5)
    base = ["".join(rng.choices("abcdefgh ", k=60)) for _ in range(8)]
    rows = [(i, "\n".join(rng.choice(base)[:-3] + rng.choice(["abc", "xyz", "qrs"]) for _ in range(3))) for i in range(40)]
    docs = documents(spark, rows).selectExpr("doc_id", "text", "xxhash64(text) doc").repartition(3)
    got = {(r["bucket"], r["node"]) for r in line_dedup.shared_buckets(line_dedup.cut(line_dedup.all_lines(docs, 8), "test")).collect()}
    lines = sorted({x for _, t in rows for x in line_dedup.normal_lines(t)[1]})
    node = [int.from_bytes(k[:8], "little", signed=True) for k in line_dedup.line_keys(lines)]
    every = [(int(b), n) for n, bs in zip(node, line_dedup.bands(line_dedup.signatures(lines, 8)), strict=True) for b in bs]
    size = collections.Counter(b for b, _ in every)
    assert got == {(b, n) for b, n in every if size[b] > 1}


@pytest.mark.parametrize("seed", range(3))
def test_comparisons_by_sorting_equal_sets(seed):
    rng = np.random.default_rng(seed)
    values = [rng.choice(rng.integers(0, 2**63, 300).astype(np.uint64), rng.integers(1, 200), replace=False) for _ in range(12)]
    pool = np.unique(np.concatenate(values))
    values = [np.sort(rng.choice(pool, rng.integers(1, 200), replace=False)) for _ in values]
    a, b = rng.integers(0, 12, 40), rng.integers(0, 12, 40)
    column = lambda of: pa.array([values[i].tobytes() for i in of], pa.binary())
    t = pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), column(a), column(b)], ["a", "b", "s_a", "s_b"])
    for i, j, v in pairs.steps(t, pairs.from_bytes):
        _, common, na, nb = pairs.compared(v, j - i)
        n, words, begin, loose = pairs.hits_of(v, j - i)
        for x in range(i, j):
            p, q = set(values[a[x]].tolist()), set(values[b[x]].tolist())
            assert (na[x - i], nb[x - i]) == (len(p), len(q)) == (len(p), n[x - i])
            mine = words[begin[x - i] : begin[x - i + 1]]
            assert sum(int(w).bit_count() for w in mine.view(np.uint64)) == len(q) - loose[x - i] >= len(p & q)
            for y in range(i, j):
                if a[y] == a[x]:  # the bound on what two sets beside the same one have in common
                    other = words[begin[y - i] : begin[y - i + 1]]
                    both = sum(int(w).bit_count() for w in (mine & other).view(np.uint64)) + min(loose[x - i], loose[y - i])
                    assert both >= len(q & set(values[b[y]].tolist()))


def test_very_long_lines(spark):
    rng = random.Random(2)
    long = "".join(rng.choices("abcdefghij ", k=1_500_000))
    rows = [(1, long), (2, long[:700_000] + "X" + long[700_000:]), (3, " " * 2_000_000 + "\n" * 10), (4, "w" * 1_200_000 + "\nlast")]
    got = {r["doc_id"]: (r["n_lines"], r["dropped"]) for r in line_dedup.line_counts(documents(spark, rows)).collect()}
    assert got == {1: (1, ""), 2: (1, "0"), 3: (0, ""), 4: (2, "")}


def test_short_lines_whose_bits_differ_much(spark):
    rng, pairs = random.Random(3), []
    for _ in range(20):
        b = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(1000)]  # 5 shingles, 4 of them in a
        x, y = (line_dedup.signatures(lines, 8) for lines in ([s[:11] for s in b], b))
        differ = sum(np.bitwise_count(p ^ q) for p, q in zip(line_dedup.low_bits(x).T.view(np.uint64), line_dedup.low_bits(y).T.view(np.uint64), strict=True))
        meet = (line_dedup.bands(x) == line_dedup.bands(y)).any(1)
        pairs += [b[i] for i in np.flatnonzero(meet & (differ > line_dedup.FEW_BITS))]
    assert len(pairs) > 5
    rows = [(i, f"{s[:11]}\n{s}") for i, s in enumerate(pairs)]
    got = {r["doc_id"]: r["dropped"] for r in line_dedup.line_counts(documents(spark, rows)).collect()}
    assert got == {i: "1" for i in range(len(rows))}
