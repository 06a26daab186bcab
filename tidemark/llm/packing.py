"""Packing documents into sequences: best-fit decreasing over a segment tree of remaining capacities."""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: The vocabulary family's own split of a text (a fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

PACKED = f"{PIECES}, sequence_id long, offset long"


class FastIds:
    """Ids of a byte-level BPE vocabulary in a tokenizers file.

    tiktoken reads the same vocabulary and finds the same ids about four times as fast (compared for every code point in
    the tests). A text that may hold one of the vocabulary's special tokens, or that tiktoken refuses (its pattern engine
    gives up on blank runs of about a million characters), goes to tokenizers itself."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the file
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.fast = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        if not any(t in text for t in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
            except ValueError:
                pass  # too long a run for its pattern engine
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=2)
def ids_of(path: str) -> FastIds:
    """Kept for the later tasks of a Python worker."""
    return FastIds(path)


def pieces_of(ids: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of full windows and the rest."""
    raw, n = ids.tobytes(), len(ids)
    return [(s, min(window, n - s), zlib.crc32(raw[4 * s : 4 * (s + window)])) for s in range(0, n, window)]


class OpenWindows:
    """Open windows by remaining capacity, with a segment tree that knows which capacities have one."""

    def __init__(self, window: int):
        self.leaves = 1
        while self.leaves < window + 1:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.at: list[list] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, n: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += n
            i //= 2

    def put(self, capacity: int, window_id: int) -> None:
        if capacity:
            self.at[capacity].append(window_id)
            self._add(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """The tightest open window with at least that capacity."""
        count, i = self.count, least + self.leaves
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i //= 2
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if count[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        window_id = self.at[capacity].pop()
        self._add(capacity, -1)
        return capacity, window_id


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; the pieces come in descending length."""
    tree, used, n = OpenWindows(window), [], 0
    seq, off = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        got = tree.take(length) if length < window else None
        if got is None:
            seq[i], off[i] = n, 0
            used.append(length)
            tree.put(window - length, n)
            n += 1
        else:
            capacity, w = got
            seq[i], off[i] = w, used[w]
            used[w] += length
            tree.put(capacity - length, w)
    return seq, off


def pack(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1, bucket_pieces: int = 50_000) -> DataFrame:
    """One row per piece of each document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The ids of a whole text plus end_id are cut into full windows and a rest. Pieces are dealt by a hash of
    (doc_id, start, number of the row in its task) into buckets of about bucket_pieces, and each bucket is packed by best-fit decreasing: only the last
    open windows of a bucket hold padding that a global packing would not. Each bucket fits one task whatever the input.

    Nulls: a null text is empty and yields one piece with end_id alone; a null doc_id is kept. Repeated rows are each
    packed. An empty table yields no rows. Other columns of docs are ignored. Very long texts have many pieces."""

    def tokenize(batches):
        tokenizer, end, n_pieces, base = ids_of(tokenizer_path), np.array([end_id], "<u4"), 0, TaskContext.get().partitionId() << 32
        names = [c.split()[0] for c in PIECES.split(", ")]
        for b in batches:
            out = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = np.concatenate((tokenizer.encode(text.as_py()), end))
                n = len(ids)
                out += [(doc, s, length, crc, n) for s, length, crc in pieces_of(ids, window)]
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            salt = np.arange(n_pieces, n_pieces + len(out)) + base
            n_pieces += len(out)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), pa.array(salt)], [*names, "salt"])

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable", na_position="last").reset_index(drop=True)
        seq, off = best_fit_decreasing(pdf["length"].to_numpy(), window)
        pdf["sequence_id"], pdf["offset"] = seq + (pdf["bucket"].to_numpy(np.int64) << 32), off
        return pdf.drop(columns="bucket").astype({"doc_id": "Int64"})

    pieces = cut(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tokenize, PIECES + ", salt long"), "pieces")
    buckets = max(1, -(-pieces.count() // bucket_pieces))
    return pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "salt"), F.lit(buckets))).drop("salt").groupBy("bucket").applyInPandas(fill, PACKED)
