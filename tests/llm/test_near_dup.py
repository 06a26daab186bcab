import itertools
import random

import numpy as np
from helpers import Sets, documents, empty, sentence, texts

from tidemark.llm import near_dup
from tidemark.llm.common import lower_words
from tidemark.llm.components import components


def shingle_set(text, k):
    w = lower_words(text)
    return {tuple(w)} - {()} if len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, percent):
    sets = {i: shingle_set(t, k) for i, t in rows}
    u = Sets()
    for a, b in itertools.combinations(sets, 2):
        inter = len(sets[a] & sets[b])
        if inter and 100 * inter >= percent * len(sets[a] | sets[b]):
            u.join(a, b)
    return {i: (len(sets[i]), u.find(i), u.find(i) == i) for i in sets}


def test_components_equal_brute_force(spark):
    for k, seed in ((4, 1), (5, 2)):
        rows = list(enumerate(texts(seed, families=8, copies=8)))
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(documents(spark, rows), k).collect()}
        assert got == brute(rows, k, 80)


def test_one_large_group_of_variants(spark):
    base = texts(3)[10].split(" ") * 4
    rng = np.random.default_rng(3)
    rows = []
    for i in range(150):
        w = list(base)
        for at in rng.choice(len(w), rng.integers(0, 9), replace=False):
            w[at] = f"v{rng.integers(10**6)}"
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(documents(spark, rows), 4).collect()}
    assert got == {i: c for i, (_, c, _) in brute(rows, 4, 80).items()}


def test_nulls_repeats_and_empty(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (9, None), (8, "")]
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(documents(spark, rows), 4).collect()), key=str)
    assert got == sorted([(None, None, True)] * 2 + [(5, 5, True), (7, 5, False), (7, 5, False), (9, 9, True), (8, 8, True)], key=str)
    assert near_dup.near_duplicates(empty(spark), 4).count() == 0
    kept = near_dup.without_near_duplicates(documents(spark, rows), 4)
    assert kept.columns == documents(spark, rows).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [5, 8, 9, None, None]


def test_ids_with_several_texts(spark):
    rng = random.Random(9)
    a, b, c = (" ".join(sentence(rng, 60).split()) for _ in range(3))
    rows = [(5, a), (5, b), (6, a + " end"), (7, b + " end"), (8, c), (3, c + " end"), (8, a + " x"), (9, "quite another text of some words"), (9, None), (10, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in near_dup.near_duplicates(df, 4).collect()}
    assert got == {(i, 3) for i in (3, 5, 6, 7, 8)} | {(9, 9), (10, 10)}
    kept = sorted(((r["doc_id"], r["text"]) for r in near_dup.without_near_duplicates(df, 4).collect()), key=str)
    assert kept == sorted([(5, a), (5, b), (3, c + " end"), (9, "quite another text of some words"), (9, None), (10, "")], key=str)
    again = near_dup.without_near_duplicates(df.unionByName(df), 4).count()
    assert again == len(kept) + 2  # rows without words all stay


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    u = rng.integers(1, 2**63, 900).astype(np.uint64)
    a, b = u[:600], u[300:]
    ra, rb = near_dup.registers(a), near_dup.registers(b)
    assert (np.maximum(ra, rb) == near_dup.registers(u)).all()
    assert abs(near_dup.likely(np.array([600.0]), np.array([600.0]), ra[None], rb[None])[0] - 1 / 3) < 0.1


def test_components_of_chains_stars_and_loops(spark):
    rng = np.random.default_rng(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(int(a), int(b)) for a, b in rng.integers(200, 260, (50, 2))] + [(9, 9)]
    u = Sets()
    for a, b in links:
        u.join(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: u.find(x) for a, b in links if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
