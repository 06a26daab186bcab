"""Verification of candidate pairs on whole sets, and bounds that spare most of them.

Sets are in tables (id, s); `sets` makes of a list of values of s their 64-bit hashes in a row and where each begins, by
default from their bytes. A step compares many pairs by one sort: of each hash HASH_BITS bits count there."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Pairs and hashes that one step looks at together; a pair that has more stands alone.
STEP_PAIRS, STEP_HASHES = 1 << 10, 300_000
HASH_BITS = 53
#: Members of a bucket that one task compares with others.
BLOCK = 1000


def from_bytes(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(values), np.uint64), np.cumsum([0, *(len(v) // 8 for v in values)])


def with_centre(members: DataFrame, node: str) -> DataFrame:
    """Members (bucket, node) with a, the member of their bucket that meets most others: of a group of variants the one in
    the middle, to which most are linked, shares most bands. Ties go to the smaller."""
    size = members.groupBy("bucket").agg(F.count("*").alias("size"))
    meets = members.join(size, "bucket").groupBy(node).agg(F.sum("size").alias("meets"))
    return by_most(members.join(meets, node), node)


def by_most(members: DataFrame, node: str) -> DataFrame:
    """Members (bucket, node, meets) with a, that of their bucket with the largest `meets`; ties go to the smaller."""
    centre = members.groupBy("bucket").agg(F.max_by(node, F.struct("meets", -F.col(node))).alias("a"))
    return members.drop("meets").join(centre, "bucket")


def steps(t: pa.RecordBatch, sets):
    """Of a batch (.., .., s_a, s_b): ranges of rows (i, j) and, for all their pairs, the sorted distinct words
    pair | hash | side (0: a)."""
    size = sum(pc.fill_null(pc.binary_length(t.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 3))
    width = 8 if pa.types.is_binary(t.schema.field(2).type) else 1
    i = 0
    while i < t.num_rows:
        j, total = i, 0
        while j < t.num_rows and j - i < STEP_PAIRS and (j == i or total + size[j] // width <= STEP_HASHES):
            total += size[j] // width
            j += 1
        number: dict = {}
        at = [np.fromiter((number.setdefault(v, len(number)) for v in t.column(c).slice(i, j - i).to_pylist()), np.int64, j - i) for c in (2, 3)]
        h, begin = sets(list(number))
        out = []
        for side, of in enumerate(at):
            n = begin[of + 1] - begin[of]
            each = np.arange(n.sum()) + np.repeat(begin[of] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
            out.append((np.repeat(np.arange(j - i, dtype=np.uint64) << np.uint64(HASH_BITS + 1), n) | (h[each] >> np.uint64(64 - HASH_BITS) << np.uint64(1))) | np.uint64(side))
        v = np.concatenate(out)
        v.sort()
        yield i, j, v[np.concatenate(([True], v[1:] != v[:-1]))] if len(v) else v
        i = j


def compared(v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of steps() with n pairs: the pair of each word, which of them are of side b and in a as well, and the
    sizes of both sets of each pair."""
    pair = (v >> np.uint64(HASH_BITS + 1)).astype(np.int64)
    of_b = (v & np.uint64(1)).astype(bool)
    common = of_b.copy()
    common[1:] &= (v[1:] ^ np.uint64(1)) == v[:-1]
    common[:1] = False
    nb = np.bincount(pair[of_b], minlength=n)
    return pair, common, np.bincount(pair, minlength=n) - nb, nb


def verified(close: DataFrame, whole: DataFrame, percent: int, sets=from_bytes) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""

    def compare(batches):
        for t in batches:
            keep = []
            for i, j, v in steps(t, sets):
                pair, common, na, nb = compared(v, j - i)
                both = np.bincount(pair[common], minlength=j - i)
                keep.append(100 * both >= percent * (na + nb - both))
            if keep:
                yield t.select(["a", "b"]).filter(pa.array(np.concatenate(keep)))

    x, y = whole.select(F.col("id").alias("a"), F.col("s").alias("s_a")), whole.select(F.col("id").alias("b"), F.col("s").alias("s_b"))
    return cut(close.join(x, "a").join(y, "b").select("a", "b", "s_a", "s_b").mapInArrow(compare, "a long, b long").distinct(), "links")


def hits_of(v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """See beside_first(), for the words of steps() with n pairs: sizes of rep's sets, 64-bit words of hits, where each
    pair's begin, and loose."""
    pair, common, na, nb = compared(v, n)
    of_b = (v & np.uint64(1)).astype(bool)
    inner = -(-na // 64) * 64
    outer = 64 << np.maximum(0, np.ceil(np.log2(np.maximum(4 * na // 64, 1)))).astype(np.int64)
    begin = np.concatenate(([0], np.cumsum(inner + outer)))
    rank = np.cumsum(~of_b) - 1 - (np.cumsum(na) - na)[pair]  # of the latest word of a in its set
    bits = np.zeros(begin[-1], np.uint8)
    bits[begin[pair[common]] + rank[common]] = 1
    other = of_b & ~common
    bits[begin[pair[other]] + inner[pair[other]] + ((v[other] >> np.uint64(1)).astype(np.int64) & (outer[pair[other]] - 1))] = 1
    return nb, np.packbits(bits).view(np.int64), begin // 64, nb - np.add.reduceat(bits, begin[:-1], dtype=np.int64)


def beside_first(pairs: DataFrame, whole: DataFrame, sets=from_bytes) -> DataFrame:
    """Of pairs (a, rep): n, the size of rep's set; hits, a bit for each shingle of a that rep has, then a bit for each of
    rep's others by hash (four times as many bits as a has shingles); and loose, how many of these others share a bit.

    Two sets have at most as many shingles in common as equal bits in hits, and the smaller `loose`: the first part counts
    shingles of a exactly, and every other common one sets an equal bit or hides behind another of its own set."""

    def compare(batches):
        for t in batches:
            for i, j, v in steps(t, sets):
                n, words, begin, loose = hits_of(v, j - i)
                hits = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(words, pa.int64()))
                yield pa.RecordBatch.from_arrays([t.column(0).slice(i, j - i), t.column(1).slice(i, j - i), pa.array(n, pa.int64()), hits, pa.array(loose, pa.int64())], ["a", "rep", "n", "hits", "loose"])

    x, y = whole.select(F.col("id").alias("a"), F.col("s").alias("s_a")), whole.select(F.col("id").alias("rep"), F.col("s").alias("s_rep"))
    return pairs.join(x, "a").join(y, "rep").select("a", "rep", "s_a", "s_rep").mapInArrow(compare, "a long, rep long, n long, hits array<long>, loose long")


def across(some: DataFrame, all_: DataFrame, percent: int, words: tuple[str, ...] = (), most: int = 0, free: str = "") -> DataFrame:
    """Pairs (a, b) of a bucket in different components that can be linked, by bounds on what they have in common:
    `common` of each (its size, or less), and the bits of beside_first(). Where `words` names columns of sketch bits, at
    most `most` of these may differ, unless the column `free` is true on either side. `members` is the size of the bucket,
    or more. The one side holds the members outside of the bucket's largest component, so that a large group costs a
    comparison for each of them only."""
    x, y = some.select("bucket", *[F.col(c).alias(f"x_{c}") for c in all_.columns if c != "bucket"]), all_

    def enough(common):
        return (100 + percent) * common >= percent * (F.col("n") + F.col("x_n"))

    both = F.aggregate(F.zip_with("x_hits", "hits", lambda p, q: F.bit_count(p.bitwiseAND(q))), F.lit(0), lambda t, v: t + v)
    # Members of a large bucket meet in blocks, so that its comparisons spread over tasks.
    blocks = F.ceil(F.col("members") / BLOCK)
    x = x.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("x_members") / BLOCK) - 1))).drop("x_members")
    y = y.withColumn("block", F.pmod(F.xxhash64("rep"), blocks)).drop("members")
    near = (F.col("x_root") != F.col("root")) & enough(F.least("x_common", "common"))
    if words:
        alike = sum((F.bit_count(F.col(f"x_{w}").bitwiseXOR(F.col(w))) for w in words), F.lit(0)) <= most
        near &= alike | F.col(f"x_{free}") | F.col(free) if free else alike
    near &= enough(both + F.least("x_loose", "loose"))
    return x.join(y, (x["bucket"] == y["bucket"]) & (x["block"] == y["block"]) & near).select(F.least("x_rep", "rep").alias("a"), F.greatest("x_rep", "rep").alias("b"))
