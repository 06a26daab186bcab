"""Fuzzy line deduplication: MinHash of character shingles, banding, exact Jaccard, distributed union-find."""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Sieve, cut, mix64, odd_numbers, slices
from .components import components
from .pairs import across, beside_first, by_most, verified

#: Rows in a band and bands: lines at a similarity of 0.8 share no band with a probability of 6e-4, at 0.9 of 3e-7.
BAND, BANDS = 4, 14
BINS = BAND * BANDS
#: Four bits of each bin, in four words of BINS bits. At a similarity of 0.8, 22 of the 224 differ, with a deviation of 7;
#: pairs with more than FEW_BITS differing (five deviations) aren't verified. Lines of fewer than FEW shingles fill few
#: bins, which then aren't independent: their pairs are verified whatever their bits.
BIT_WORDS, FEW_BITS, FEW = 4, 57, 20
WORDS = tuple(f"w{i}" for i in range(BIT_WORDS))
#: White space that parts words, beyond ASCII.
OTHER_SPACE = re.compile("[" + "".join(c for c in map(chr, range(0x80, 0x3001)) if c.isspace()) + "]")
#: Lines whose band keys form one chunk, and keys that one shard compares.
CHUNK_LINES, SHARD_KEYS = 25_000, 400_000


def spaced(x: str) -> bool:
    """Whether a text holds white space other than single spaces and line feeds."""
    if "  " in x or "\t" in x or "\r" in x or "\x0b" in x or "\x0c" in x or "\x1c" in x or "\x1d" in x or "\x1e" in x or "\x1f" in x:
        return True
    return not x.isascii() and OTHER_SPACE.search(x) is not None


def normal_lines(text: str | None) -> tuple[list[int], list[str]]:
    """Numbers and normal forms of the lines that aren't blank: lower case, white space as single spaces, trimmed."""
    lower = (text or "").lower()
    every = [" ".join(x.split()) for x in lower.split("\n")] if spaced(lower) else [x.strip(" ") for x in lower.split("\n")]
    number = [i for i, x in enumerate(every) if x]
    return number, every if len(number) == len(every) else [every[i] for i in number]


def line_keys(lines: list[str]) -> list[bytes]:
    digest = xxhash.xxh3_128_digest
    try:
        return [digest(x.encode()) for x in lines]
    except UnicodeEncodeError:  # lone surrogates
        return [digest(x.encode("utf-8", "surrogatepass")) for x in lines]


def narrow_shingles(text: bytes) -> np.ndarray:
    """The bytes at each place of Latin-1 text with the seven after it, as one number."""
    return np.ndarray((max(0, len(text) - 7),), "<u8", text, 0, (1,)).copy()


def wide_shingles(text: str, k: int) -> np.ndarray:
    """A number for the k characters at each place; the same as that of narrow_shingles() if k is 8 and all are Latin-1."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = max(0, len(code) - k + 1)
    m, out = odd_numbers(k, 21), np.zeros(n, np.uint64)
    for i in range(k):
        out += code[i : i + n] * m[i]
    if k == 8:
        few = np.cumsum(np.concatenate(([0], code > 255)))
        narrow, packed = few[k:] == few[: len(few) - k], np.zeros(n, np.uint64)
        for i in range(k):
            packed |= (code[i : i + n] & np.uint64(255)) << np.uint64(8 * i)
        out = np.where(narrow, packed, mix64(out))
    return out


def shingles(lines: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the k-character shingles of all lines in a row, and where each line's begin; a shorter line is
    one shingle. Eight Latin-1 characters are one number before it is hashed."""
    lines = [line if len(line) >= k else line.ljust(k, "\0") for line in lines]
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    text = "".join(lines)
    try:
        h = narrow_shingles(text.encode("latin-1")) if k == 8 else wide_shingles(text, k)
    except UnicodeEncodeError:
        h = wide_shingles(text, k)
    inside = np.ones(len(h), bool)
    if k > 1:
        inside[(np.cumsum(size)[:-1, None] - np.arange(1, k)).reshape(-1)] = False  # windows that reach into the next line
    h = h[inside]
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h, np.concatenate(([0], np.cumsum(size - k + 1)))


def order_of_bins() -> np.ndarray:
    """For each bin the others in a fixed random order: where an empty bin looks for its value."""
    rng = np.random.default_rng(10)
    return np.array([rng.permutation(np.delete(np.arange(BINS), i)) for i in range(BINS)])


ORDER = order_of_bins()


def signatures(lines: list[str], k: int) -> np.ndarray:
    """BINS values of each line: one hash a shingle, the least in each bin by one-permutation MinHash; an empty bin takes
    the value of the first filled one in its order, so that bins agree with the probability of the similarity."""
    h, begin = shingles(lines, k)
    bins = h >> np.uint64(32)
    bins *= np.uint64(BINS)
    bins >>= np.uint64(32)
    bins = bins.view(np.int64)
    bins += np.repeat(np.arange(len(lines)) * BINS, np.diff(begin))
    least = np.full(len(lines) * BINS, 2**64 - 1, np.uint64)
    np.minimum.at(least, bins, (h << np.uint64(32)) | (h >> np.uint64(32)))  # the bin says nothing about the low half
    least = least.reshape(-1, BINS)
    full = least != np.uint64(2**64 - 1)
    row, col = np.nonzero(~full)
    out = least.copy()
    for t in range(3):
        at = ORDER[col, t]
        found = full[row, at]
        out[row[found], col[found]] = least[row[found], at[found]]
        row, col = row[~found], col[~found]
    for i in range(0, len(row), 20_000):  # those that looked in vain three times
        r, c = row[i : i + 20_000], col[i : i + 20_000]
        at = ORDER[c, full[r[:, None], ORDER[c]].argmax(1)]
        out[r, c] = least[r, at]
    return out


def bands(values: np.ndarray) -> np.ndarray:
    """Band keys of signatures."""
    key = np.full((len(values), BANDS), 0x10, np.uint64) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for part in range(BAND):
        key = mix64(key ^ values[:, part::BAND])
    return key.view(np.int64)


def low_bits(values: np.ndarray) -> np.ndarray:
    """BIT_WORDS words of bits of signatures."""
    place = np.uint64(1) << np.arange(BINS, dtype=np.uint64)
    return np.stack([(((values >> np.uint64(i)) & np.uint64(1)) * place).sum(1, dtype=np.uint64) for i in range(BIT_WORDS)], axis=1).view(np.int64)


def few_shingles(values: np.ndarray) -> np.ndarray:
    """Whether signatures have fewer than FEW filled bins, as all lines of fewer shingles have."""
    return (np.diff(np.sort(values, axis=1), axis=1) != 0).sum(1) + 1 < FEW


class Seen(set):
    """Keys that a task has met; emptied at `most`, which only costs that some lines are looked at twice."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def new(self, keys: list[bytes]) -> list[int]:
        """Places of the keys that are new, the first of equal ones."""
        if len(self) >= self.most:
            self.clear()
        first: dict[bytes, int] = {}
        for i, key in enumerate(keys):
            if key not in self and key not in first:
                first[key] = i
        self.update(first)
        return list(first.values())


LINES = "doc_id long, doc long, line int, node long, other long, chunk long, keys binary"


def all_lines(docs: DataFrame, k: int) -> DataFrame:
    """All lines that aren't blank: doc_id, doc (hash of the text), line, and both halves of the line's key (node, other).
    A row with line -1 stands for the document itself and has the number of its lines as node. Rows with a chunk hold,
    in keys, nodes and band keys of up to CHUNK_LINES lines that differ, the first of equal ones that a task meets."""

    def work(batches):
        seen, nodes, found_bands, waiting, n = Seen(), [], [], 0, 0
        base = TaskContext.get().partitionId() << 32

        def chunk():
            nonlocal n, waiting
            node, first = np.unique(np.concatenate(nodes), return_index=True)
            packed = node.tobytes() + np.concatenate(found_bands)[first].tobytes()
            nodes.clear()
            found_bands.clear()
            n, waiting = n + 1, 0
            none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())]
            return pa.RecordBatch.from_arrays([*none, pa.array([base + n], pa.int64()), pa.array([packed], pa.binary())], names)

        names = [c.split()[0] for c in LINES.split(", ")]
        for b in (batch.slice(i, 500) for batch in batches for i in range(0, batch.num_rows, 500)):
            texts = b.column(1).to_pylist()
            for i, j in slices(texts, 100_000):
                found = [normal_lines(t) for t in texts[i:j]]
                count, line, every = [len(x) for x, _ in found], [n for x, _ in found for n in x], [x for _, y in found for x in y]
                keys = line_keys(every)
                at = seen.new(keys)
                fresh = [every[x] for x in at]
                raw = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
                of = pa.array(np.concatenate((np.repeat(np.arange(i, j), count), np.arange(i, j))))
                size, none = len(of), np.full(j - i, -1)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(of), b.column(2).take(of), pa.array(np.concatenate((np.array(line, np.int32), none.astype(np.int32)))),
                        pa.array(np.concatenate((raw[:, 0], np.array(count, np.int64)))), pa.array(np.concatenate((raw[:, 1], none))), pa.nulls(size, pa.int64()), pa.nulls(size, pa.binary()),
                    ],
                    names,
                )
                if fresh:
                    nodes.append(raw[at, 0])
                    found_bands.append(bands(signatures(fresh, k)))
                    waiting += len(fresh)
                    if waiting >= CHUNK_LINES:
                        yield chunk()
        if waiting:
            yield chunk()

    return docs.select("doc_id", "text", "doc").mapInArrow(work, LINES)


def unpacked(keys: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk: nodes, and its distinct band keys in order with, for each, the place of its first line and its number
    of lines, as rows of a table; and the number of each key of each line among them."""
    raw = np.frombuffer(keys, np.int64)
    n = len(raw) // (1 + BANDS)
    key, first, place, count = np.unique(raw[n:].view(np.uint64), return_index=True, return_inverse=True, return_counts=True)
    return raw[:n], key, np.stack((first // BANDS, count)), place.reshape(n, BANDS)


def edges(key: np.ndarray, shards: int) -> np.ndarray:
    """Where the keys of each shard, a range of all keys, begin and end."""
    return np.searchsorted(key, np.array([(s << 64) // shards for s in range(1, shards)], np.uint64), "left").tolist()


def asked(chunks: DataFrame, shards: int) -> DataFrame:
    """The distinct band keys of each chunk by shard, packed: keys, the node of the first line with each, and how many
    lines of the chunk have it. A key is one entry a chunk, however many lines share it."""

    def work(batches):
        for t in batches:
            for chunk, keys in zip(t.column(0).to_pylist(), t.column(1), strict=True):
                node, key, (first, count), _ = unpacked(keys.as_py())
                parts = (key, node[first], count.astype(np.uint32))
                edge = [0, *edges(key, shards), len(key)]
                rows = [(s, *(x[i:j].tobytes() for x in parts)) for s, (i, j) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if j > i]
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(rows), pa.int64()), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], ["chunk", "shard", "key", "node", "n"])

    return chunks.mapInArrow(work, "chunk long, shard int, key binary, node binary, n binary")


def answered(requests: DataFrame) -> DataFrame:
    """For each row of asked(), how many lines of all chunks share each key (n: 16 bits each, 0 if one line alone has it;
    a line that several chunks hold counts as often)."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        key, node, n = (np.concatenate([np.frombuffer(x, t) for x in pdf[c]]) for c, t in (("key", np.uint64), ("node", np.int64), ("n", np.uint32)))
        order = np.argsort(key)
        new = np.concatenate(([True], np.diff(key[order]) != 0))
        begin = np.flatnonzero(new)
        node, n = node[order], n[order]
        several = (np.minimum.reduceat(node, begin) != np.maximum.reduceat(node, begin)) | (np.maximum.reduceat(n, begin) > 1)
        total = np.where(several, np.minimum(np.add.reduceat(n.astype(np.int64), begin), 65_535), 0).astype(np.uint16)
        answer = np.empty(len(key), np.uint16)
        answer[order] = total[np.cumsum(new) - 1]
        edge = np.cumsum([0, *(len(x) // 8 for x in pdf["key"])])
        return pd.DataFrame({"chunk": pdf["chunk"], "shard": pdf["shard"], "n": [answer[i:j].tobytes() for i, j in zip(edge[:-1], edge[1:], strict=True)]})

    return requests.groupBy("shard").applyInPandas(work, "chunk long, shard int, n binary")


def shared_buckets(lines: DataFrame) -> DataFrame:
    """bucket, node, meets: lines (by node) with each of their band keys that another line shares, and how many lines
    share any of their keys. Band keys are shuffled in packed form, and only shared ones become rows."""
    chunks = lines.where("chunk is not null").select("chunk", "keys")
    n_keys = chunks.agg(F.sum(F.length("keys"))).first()[0] or 0
    answers = answered(asked(chunks, max(1, n_keys // 8 // SHARD_KEYS)))
    both = chunks.select("chunk", F.lit(-1).alias("shard"), F.col("keys").alias("n")).unionByName(answers)

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard")
        node, _, _, place = unpacked(pdf["n"].iat[0])
        total = np.frombuffer(b"".join(pdf["n"].iloc[1:]), np.uint16)[place]
        row, band = np.nonzero(total)
        raw = np.frombuffer(pdf["n"].iat[0], np.int64)[len(node) :].reshape(-1, BANDS)
        return pd.DataFrame({"bucket": raw[row, band], "node": node[row], "meets": total.sum(1, dtype=np.int64)[row]})

    return both.groupBy("chunk").applyInPandas(work, "bucket long, node long, meets long").distinct()


def member_texts(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """id, s (normal form), sketch bits and few (see few_shingles) of the lines in nodes."""
    shared = docs.sparkSession.sparkContext.broadcast(Sieve(nodes, "node"))

    def work(batches):
        seen = Seen()
        for b in (batch.slice(i, 500) for batch in batches for i in range(0, batch.num_rows, 500)):
            texts = b.column(0).to_pylist()
            for i, j in slices(texts, 100_000):
                lines = [x for t in texts[i:j] for x in normal_lines(t)[1]]
                keys = line_keys(lines)
                node = np.frombuffer(b"".join(keys), "<i8")[::2].copy()
                ok = np.flatnonzero(shared.value.may_have(node))
                ok = ok[seen.new([keys[x] for x in ok])]
                if len(ok):
                    lines = [lines[x] for x in ok]
                    values = signatures(lines, k)
                    bits = low_bits(values)
                    yield pa.RecordBatch.from_arrays([pa.array(node[ok]), pa.array(lines, pa.string()), *[pa.array(np.ascontiguousarray(bits[:, w])) for w in range(BIT_WORDS)], pa.array(few_shingles(values))], ["id", "s", *WORDS, "few"])

    rows = docs.select("text").mapInArrow(work, "id long, s string, " + ", ".join(f"{w} long" for w in WORDS) + ", few boolean")
    return cut(rows.join(nodes.withColumnRenamed("node", "id"), "id", "left_semi").dropDuplicates(["id"]), "line-texts")


def near_enough(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketch bits allow for a link, and those of lines with few shingles."""
    a, b = (texts.select(F.col("id").alias(c), *[F.col(x).alias(f"{c}_{x}") for x in (*WORDS, "few")]) for c in "ab")
    differ = sum((F.bit_count(F.col(f"a_{w}").bitwiseXOR(F.col(f"b_{w}"))) for w in WORDS), F.lit(0))
    return pairs.join(a, "a").join(b, "b").where((differ <= FEW_BITS) | F.col("a_few") | F.col("b_few")).select("a", "b")


def duplicate_lines(docs: DataFrame, k: int = 8, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """doc_id, doc, dropped: the lines to drop, of each document with any (doc is xxhash64 of the text, lines count from
    0); and the table of all_lines().

    Lines of all documents, in normal form, are linked if their sets of k-character shingles share percent of their
    union. Of each component the first line by (doc_id, hash of the text, number) stays. Blank lines aren't lines.

    1. One pass writes keys of all lines, and band keys of those that differ, packed in chunks. 2. Shards of the band keys
    tell each chunk which of its keys another line shares; only these become rows (bucket, node). 3. A second pass fetches
    the texts of their lines; a bounded sieve keeps all else out of the shuffle. 4. Each node of a bucket is paired with
    its centre; sketch bits, then whole shingle sets decide. 5. Components. 6. Pairs across the components of a bucket are
    decided too, after exact bounds and sketch bits have ruled out what can't be linked, and components formed anew; bits
    decide nothing for lines of few shingles. 7. Lines of equal normal form share a key; the first of a component's lines
    stays. No step gathers a group in one task: minima are combined first, a key is one entry a chunk, and joins have
    the small side unique by key. A node is 64 bits of a line's 128-bit key: among a billion different lines two share one
    with a probability of 3%, and are then linked alike.

    Nulls: a null or empty text has no lines; a null doc_id comes first in order. Rows that repeat doc_id and text are
    one document here and lose the same lines. An empty table yields no rows. Very long lines are compared whole."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("doc"))
    lines = cut(all_lines(docs, k), "lines")
    members = cut(by_most(cut(shared_buckets(lines), "line-buckets"), "node"), "line-members")
    texts = member_texts(docs, cut(members.select("node").distinct(), "line-nodes"), k)
    star = cut(members.where("node <> a").select("a", F.col("node").alias("b")).distinct(), "line-star")
    sets = partial(shingles, k=k)
    links = verified(near_enough(star, texts), texts, percent, sets)
    roots = cut(components(links, "line-components"), "line-roots").withColumnRenamed("node", "of")

    placed = members.join(roots, F.col("node") == F.col("of"), "left").select("bucket", "a", F.col("node").alias("rep"), F.coalesce("root", "node").alias("root"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("members")).where("lo < hi").select("bucket", "members")
    mixed = cut(placed.join(mixed, "bucket"), "line-mixed")
    if not mixed.isEmpty():
        beside = beside_first(mixed.select("a", "rep").distinct(), texts, sets)
        bits = texts.select(F.col("id").alias("rep"), *WORDS, "few")
        placed = cut(mixed.join(beside.withColumn("common", F.col("n")), ["a", "rep"]).join(bits, "rep").drop("a"), "line-placed")
        main = placed.groupBy("bucket", "root").count().groupBy("bucket").agg(F.max_by("root", F.struct("count", "root")).alias("main"))
        rest = across(placed.join(main, "bucket").where("root <> main"), placed, percent, WORDS, FEW_BITS, "few").distinct().join(star, ["a", "b"], "left_anti")
        more = verified(cut(rest, "line-rest"), texts, percent, sets)
        if not more.isEmpty():
            roots = cut(components(links.unionByName(more), "line-components"), "line-roots").withColumnRenamed("node", "of")

    # A line that stands alone can't go; the others are those that occur twice or have a root.
    lines = lines.where("chunk is null")
    each = lines.where("line >= 0").select("doc_id", "doc", "line", "node", "other")
    twice = each.groupBy("node", "other").agg(F.count("*").alias("n")).where("n > 1").select("node").distinct()
    group = twice.join(roots, F.col("node") == F.col("of"), "full").select(F.coalesce("node", "of").alias("node"), "root")
    grouped = each.join(group, "node").select("doc_id", "doc", "line", F.coalesce("root", "node").alias("root"), F.when(F.col("root").isNull(), F.col("other")).alias("other"))
    grouped = cut(grouped, "line-groups")
    keeper = grouped.groupBy("root", "other").agg(F.min(F.struct("doc_id", "doc", "line")).alias("keeper")).withColumnsRenamed({"root": "of", "other": "also"})
    gone = grouped.join(keeper, (F.col("root") == F.col("of")) & F.col("other").eqNullSafe(F.col("also"))).where(~F.struct("doc_id", "doc", "line").eqNullSafe(F.col("keeper")))
    return gone.groupBy("doc_id", "doc").agg(F.array_sort(F.collect_set("line")).alias("dropped")), lines


def line_counts(docs: DataFrame, k: int = 8, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_lines (not blank), n_dropped, dropped (line numbers, comma-joined); see duplicate_lines()."""
    drop, lines = duplicate_lines(docs, k, percent)
    a, b = lines.where("line = -1").select("doc_id", "doc", F.col("node").alias("n_lines")).alias("a"), drop.alias("b")
    both = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.doc") == F.col("b.doc")), "left")
    return both.select("a.doc_id", "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), F.coalesce(F.array_join(F.col("dropped").cast("array<string>"), ","), F.lit("")).alias("dropped"))


def without_duplicate_lines(docs: DataFrame, k: int = 8, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns, without the lines of duplicate_lines(). A document whose lines were all dropped goes;
    one that had none stays."""
    drop, _ = duplicate_lines(docs, k, percent)
    drop = drop.select(*[F.col(c).alias(f"__{c}") for c in drop.columns])
    rows = docs.withColumn("__doc_key", F.xxhash64("text"))
    rows = rows.join(drop, F.col("doc_id").cast("long").eqNullSafe(F.col("__doc_id")) & (F.col("__doc_key") == F.col("__doc")), "left").select(*docs.columns, "__dropped")
    names = docs.columns
    at, which = names.index("text"), len(names)

    def work(batches):
        for b in (batch.slice(i, 500) for batch in batches for i in range(0, batch.num_rows, 500)):
            texts, keep = b.column(at).to_pylist(), []
            for i, d in enumerate(b.column(which).to_pylist()):
                keep.append(True)
                if d:
                    gone = set(d)
                    left = [x for n, x in enumerate(texts[i].split("\n")) if n not in gone]
                    texts[i], keep[i] = "\n".join(left), any(x.strip() for x in left)
            cols = list(b.columns[:which])
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(work, docs.schema)
