"""What the training-data operators share: table access, words, hashes and scratch tables."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java and Python form of the one word pattern that all operators use.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of text that one Python step looks at together stay under so many code points.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one table; the path may be in any store that Spark reads."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; set to a default only where it is unset and the master is local, as in
    tests. A cluster must name one: its machines don't share their own folders."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = f"/tmp/checkpoints/{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: the lineage ends there, and lost executors
    cost no more than the rows that they were working on."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: str | None) -> list[bytes]:
    """Words of the UTF-8 text: bytes.split() parts at space and 0x09 to 0x0D only, as WORD does."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """words() with A-Z in lower case; bytes.lower() leaves all other letters alone."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHashes(dict):
    """64-bit hashes of words; emptied when it has grown to `most` entries, so that its memory is bounded."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, ws: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, on a new array."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    return np.array([xxhash.xxh3_64_intdigest(i.to_bytes(4, "little"), seed) | 1 for i in range(n)], np.uint64)


def sorted_unique(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def shingle_set(h: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; with fewer words the whole sequence is one."""
    if not len(h):
        return h
    if len(h) < k:
        s = xxhash.xxh3_64_intdigest(h.tobytes(), len(h))
        return np.array([s], np.uint64)
    m = odd_numbers(k, 4001)
    s = h[: len(h) - k + 1] * m[0]
    for i in range(1, k):
        s += h[i : len(h) - k + 1 + i] * m[i]
    return sorted_unique(mix64(s))


def id_crc(doc_id: int | None) -> int:
    """crc32 of the id as text; a null id counts as 0."""
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode())


def id_crc_column(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0).cast("long"))


def slices(texts: list[str | None], most: int = SLICE_CHARS):
    """Ranges of rows whose texts have about `most` code points together; a longer text stands alone."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if len(texts) > start:
        yield start, len(texts)


class Sieve:
    """Tells most keys of a table from others before a shuffle: one bit for each of a set of random 64-bit keys.

    It has 16 bits a key up to 2 ** most_bits in all (8 MB), so its size is bounded; beyond that it lets more through,
    and the join after it decides in any case."""

    def __init__(self, keys: DataFrame, column: str, most_bits: int = 26):
        self.bits = 1 << min(most_bits, max(10, (16 * keys.count()).bit_length()))
        at = F.col(column).bitwiseAND(F.lit(self.bits - 1))
        one = keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(at & 63)))").alias("set")).toPandas()
        self.words = np.zeros(self.bits // 64, np.uint64)
        self.words[one["word"].to_numpy(np.int64)] = one["set"].to_numpy(np.int64).view(np.uint64)

    def may_have(self, keys: np.ndarray) -> np.ndarray:
        at = keys.view(np.uint64) & np.uint64(self.bits - 1)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0
