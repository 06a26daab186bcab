import collections
import zlib

import numpy as np
import pytest
from helpers import documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import packing
from tidemark.llm.queries import tokenizer_path


def test_fast_ids_equal_the_tokenizer():
    ids = packing.ids_of(tokenizer_path())
    for i in [*range(0x3000), 0x1F600, 0x10FFFF]:
        if not 0xD800 <= i < 0xE000:
            s = f"a{chr(i)}1 {chr(i)}{chr(i)}b!{chr(i)}  {chr(i)}."
            assert ids.encode(s).tolist() == ids.whole.encode(s, add_special_tokens=False).ids
    s = "x <|endoftext|> y"
    assert ids.encode(s).tolist() == ids.whole.encode(s, add_special_tokens=False).ids


def test_fast_ids_of_every_code_point():
    ids = packing.ids_of(tokenizer_path())
    parts = ["\n".join(f"a{c}1 {c}{c}b!{c}  {c}." for c in map(chr, range(k, k + 0x800))) for k in range(0, 0x110000, 0x800) if k != 0xD800]
    for s, want in zip(parts, ids.whole.encode_batch(parts, add_special_tokens=False), strict=True):
        assert ids.encode(s).tolist() == want.ids, hex(ord(s[1]))


@pytest.mark.parametrize("run", [" " * 1_200_000, "\n" * 1_200_000, " \n" * 600_000])
def test_very_long_blank_runs(run):
    ids = packing.ids_of(tokenizer_path())
    s = f"before{run}after"
    assert ids.encode(s).tolist() == ids.whole.encode(s, add_special_tokens=False).ids


def test_one_very_long_blank_run_keeps_every_row(spark):
    rows = [(1, "one"), (2, "a" + " " * 1_200_000 + "b"), (3, "three")]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer_path(), window=1 << 16).collect()
    ids = packing.ids_of(tokenizer_path()).whole
    assert {p["doc_id"]: p["doc_tokens"] for p in pieces} == {i: len(ids.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}


@pytest.mark.parametrize("window", [16, 2048])
def test_round_trip(spark, window):
    df = documents(spark)
    pieces = packing.pack(df, tokenizer_path(), window=window, bucket_pieces=40).collect()
    ids = packing.ids_of(tokenizer_path()).whole
    want = collections.Counter()
    for r in df.collect():
        x = [*ids.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for s in range(0, len(x), window):
            part = x[s : s + window]
            want[r["doc_id"], s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(x)] += 1
    assert collections.Counter((p["doc_id"], p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in pieces) == want
    seqs = collections.defaultdict(list)
    for p in pieces:
        seqs[p["sequence_id"]].append((p["offset"], p["length"]))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= window


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_decreasing_is_best_fit(lengths):
    lengths = sorted(lengths, reverse=True)
    seq, off = packing.best_fit_decreasing(np.array(lengths, np.int64), 64)
    room = []
    for x, s, o in zip(lengths, seq.tolist(), off.tolist(), strict=True):
        fits = [r for r in room if r >= x]
        if fits:
            assert room[s] == min(fits) and o == 64 - room[s]
        else:
            assert s == len(room) and o == 0
            room.append(64)
        room[s] -= x


def test_empty_and_reruns(spark):
    assert packing.pack(empty(spark), tokenizer_path()).count() == 0
    df = documents(spark)
    a, b = (sorted(map(str, packing.pack(x, tokenizer_path()).collect())) for x in (df, df.repartition(7)))
    assert a == b


def test_little_padding(spark, sf_dir):
    rows = packing.pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), tokenizer_path()).collect()
    assert sum(r["length"] for r in rows) > 0.99 * 2048 * len({r["sequence_id"] for r in rows})


def test_equal_rows_spread_over_buckets(spark):
    df = spark.createDataFrame([(1, "a b c")] * 400, "doc_id long, text string").repartition(2)
    rows = packing.pack(df, tokenizer_path(), bucket_pieces=40).collect()
    assert len(rows) == 400 and len({r["sequence_id"] >> 32 for r in rows}) > 5


def test_blank_runs_of_millions(spark):
    texts = [" " * 1_500_000, "\n" * 1_500_000, " \n" * 600_000, " " * 1_000_000 + "x", "word " * 300_000]
    ids = packing.ids_of(tokenizer_path())
    for t in texts:
        assert ids.encode(t).tolist() == ids.whole.encode(t, add_special_tokens=False).ids
