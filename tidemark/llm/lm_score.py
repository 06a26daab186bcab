"""Language-model scores by deleted interpolation."""

from __future__ import annotations


import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, cut, id_crc, lower_words, mix64

#: Code points of the documents that form one chunk, and n-grams that one shard counts.
CHUNK_CHARS, SHARD_ENTRIES = 3_000_000, 700_000
END = xxhash.xxh3_64_intdigest(b"\0 end of text")
UNIGRAM, BIGRAM, TEXTS, FOUND = range(4)
SCHEMA = "chunk long, kind int, shard int, a binary, b binary, c binary"
#: Context-frequency bucket of a count: 0 for none, then one for each power of two.
BUCKETS = 42
#: Bins of -ln p for expectation-maximisation: an eighth each; the last bin is p = 0.
BINS, STEP = 400, 8.0


def planes(x: np.ndarray) -> bytes:
    """Bytes of the array, all first bytes before all second ones: planes of zeros compress to nothing."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def from_planes(b: bytes, dtype) -> np.ndarray:
    d = np.dtype(dtype)
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(d.itemsize, -1).T).reshape(-1).view(d)


def row_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["chunk", "kind", "shard", "a", "b", "c"])


#: What a document is used for: scored only, counted, or kept out of the counts from which the weights are learned.
SCORED, COUNTED, WEIGHED = range(3)


def use_of(doc_id: int | None, modulus: int, held_out: int) -> int:
    crc = id_crc(doc_id)
    return SCORED if crc % modulus == held_out else WEIGHED if (crc // modulus) % 6 == 0 else COUNTED


class Chunk:
    """Token numbers of some documents: `keys` are the sorted distinct word hashes, `words` numbers into them, with END
    after each document; `docs` has id, whether the id is null, tokens and use."""

    def __init__(self, keys: np.ndarray, words: np.ndarray, docs: np.ndarray):
        self.keys, self.words, self.docs = keys, words, docs

    def pack(self, chunk: int) -> tuple:
        return chunk, TEXTS, 0, planes(np.diff(self.keys, prepend=np.uint64(0))), planes(self.words.astype(np.uint32)), self.docs.tobytes()

    @classmethod
    def unpack(cls, a: bytes, b: bytes, c: bytes) -> Chunk:
        return cls(np.cumsum(from_planes(a, np.uint64), dtype=np.uint64), from_planes(b, np.uint32).astype(np.int64), np.frombuffer(c, np.int64).reshape(-1, 4))

    def uses(self) -> np.ndarray:
        """The use of each token."""
        return np.repeat(self.docs[:, 3], self.docs[:, 2])

    def before(self) -> np.ndarray:
        """The word before each token; before the first it is END."""
        end = int(np.searchsorted(self.keys, np.uint64(END)))
        out = np.empty_like(self.words)
        out[1:] = self.words[:-1]
        out[np.cumsum(self.docs[:, 2]) - self.docs[:, 2]] = end
        return out

    def grams(self):
        """Of unigrams, then of bigrams: sorted global keys, and for each token its place among them."""
        yield UNIGRAM, self.keys, self.words
        before, n = self.before(), len(self.keys)
        pair, place = np.unique(before * n + self.words, return_inverse=True)
        key = mix64(self.keys[pair // n] * np.uint64(0x9E3779B97F4A7C15) + self.keys[pair % n] * np.uint64(0xC2B2AE3D27D4EB4F))
        order = np.argsort(key, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        yield BIGRAM, key[order], rank[place]


def chunked(docs: DataFrame, modulus: int, held_out: int) -> DataFrame:
    """One row a chunk; documents that the weights are learned from have chunks of their own (odd numbers)."""

    def work(batches):
        hashes, n = WordHashes(), 0
        waiting: list[list] = [[], []]
        size = [0, 0]
        base = TaskContext.get().partitionId() << 32

        def flush(k: int):
            nonlocal n
            got, waiting[k], size[k] = waiting[k], [], 0
            h = np.concatenate([h for _, _, h in got])
            keys, place = np.unique(h, return_inverse=True)
            docs = np.array([(i or 0, i is None, len(h), use) for i, use, h in got], np.int64)
            n += 1
            return row_batch([Chunk(keys, place, docs).pack(base + 2 * n + k)])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text, use = t.as_py(), use_of(i, modulus, held_out)
                k = int(use == WEIGHED)
                ws = lower_words(text)
                h = np.empty(len(ws) + 1, np.uint64)
                h[:-1], h[-1] = hashes.of(ws), END
                waiting[k].append((i, use, h))
                size[k] += len(text or "") + 1
                if size[k] >= CHUNK_CHARS:
                    yield flush(k)
        for k in (0, 1):
            if waiting[k]:
                yield flush(k)

    return docs.mapInArrow(work, SCHEMA)


def asked(chunks: DataFrame, shards: int) -> DataFrame:
    """Distinct n-grams of each chunk by shard: a key differences, b and c counts in counted and weighed documents."""

    def work(batches):
        for t in batches:
            for chunk, a, b, c in zip(*(t.column(x).to_pylist() for x in ("chunk", "a", "b", "c")), strict=True):
                one = Chunk.unpack(a, b, c)
                use = one.uses()
                for kind, keys, place in one.grams():
                    counts = [np.bincount(place[use == u], minlength=len(keys)).astype(np.uint32) for u in (COUNTED, WEIGHED)]
                    edge = bounds(keys, shards)
                    yield row_batch([(chunk, kind, s, planes(np.diff(keys[i:j], prepend=np.uint64(0))), *(planes(x[i:j]) for x in counts)) for s, (i, j) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if j > i])

    return chunks.mapInArrow(work, SCHEMA)


def bounds(keys: np.ndarray, shards: int) -> list[int]:
    """Where each shard's keys begin among the sorted ones; shards are equal ranges of keys."""
    return [*np.searchsorted(keys, np.array([(s << 64) // shards for s in range(shards)], np.uint64)).tolist(), len(keys)]


def answered(requests: DataFrame) -> DataFrame:
    """Total counts for each row of asked(), in its order (b, c); and one row a shard with the number of unigrams of
    training documents (chunk null)."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(from_planes(a, np.uint64), dtype=np.uint64) for a in pdf["a"]]
        size = np.fromiter(map(len, keys), np.int64, len(keys))
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        edge = np.concatenate(([0], np.cumsum(size)))
        totals = []
        for c in "bc":
            sums = np.bincount(place, np.concatenate([from_planes(x, np.uint32) for x in pdf[c]]), len(every)).astype(np.uint64)
            totals.append(sums)
        kind, shard = int(pdf["kind"].iat[0]), int(pdf["shard"].iat[0])
        out = pd.DataFrame({"chunk": pdf["chunk"].astype("Int64"), "kind": kind, "shard": shard, "a": None, **{c: [planes(t[place[i:j]]) for i, j in zip(edge[:-1], edge[1:], strict=True)] for c, t in zip("bc", totals, strict=True)}})
        if kind == UNIGRAM:
            n = np.array([(totals[0] + totals[1] > 0).sum(), (totals[0] > 0).sum()], np.int64)
            out = pd.concat([out, pd.DataFrame({"chunk": pd.array([None], "Int64"), "kind": FOUND, "shard": shard, "a": [n.tobytes()], "b": None, "c": None})], ignore_index=True)
        return out

    return requests.groupBy("kind", "shard").applyInPandas(work, SCHEMA)


def bucket_of(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(n + 1.0)), BUCKETS - 1).astype(np.int64)


def looked_up(pdf: pd.DataFrame):
    """The chunk of a group and, for unigrams and bigrams, counts and weighed counts of each token; the counts of the
    word before each token."""
    text = pdf[pdf["kind"] == TEXTS].iloc[0]
    one, found = Chunk.unpack(text["a"], text["b"], text["c"]), {}
    for kind, _, place in one.grams():
        of = pdf[pdf["kind"] == kind].sort_values("shard")
        found[kind] = [np.concatenate([from_planes(x, np.uint64) for x in of[c]]).astype(np.float64) for c in "bc"]
        if kind == UNIGRAM:
            before = [x[one.before()] for x in found[kind]]
        found[kind] = [x[place] for x in found[kind]]
    return one, found[UNIGRAM], found[BIGRAM], before


def evidence(joined, n_counted: int):
    """Histogram over the tokens of weighed documents of (bucket, bin of p(w | v), bin of p(w)), from counted documents
    alone: at most BUCKETS * (BINS + 1) ** 2 cells, however large the input."""

    def bin_of(p: np.ndarray) -> np.ndarray:
        return np.where(p > 0, np.minimum(-np.log(np.maximum(p, 1e-300)) * STEP, BINS - 1), BINS).astype(np.int64)

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        if not (pdf["kind"] == TEXTS).any():
            return pd.DataFrame({"cell": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64")})
        _, uni, bi, before = looked_up(pdf)
        p2, p1 = bi[0] / np.maximum(before[0], 1), uni[0] / max(n_counted, 1)
        cell, n = np.unique((bucket_of(before[0]) * (BINS + 1) + bin_of(p2)) * (BINS + 1) + bin_of(p1), return_counts=True)
        return pd.DataFrame({"cell": cell, "n": n.astype(np.int64)})

    return joined.groupBy("chunk").applyInPandas(work, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def learn_weights(cells: np.ndarray, n: np.ndarray, p0: float, rounds: int = 60) -> np.ndarray:
    """Weights of (bigram, unigram, uniform) for each bucket by expectation-maximisation. A bucket begins at the weights
    of all held-out tokens together, which also count as ten tokens of it, so that rare buckets stay near them; in bucket 0
    (contexts that don't occur) the bigram's weight goes to the others, so that probabilities add up to one."""
    bucket, rest = cells // (BINS + 1) ** 2, cells % (BINS + 1) ** 2
    p = np.stack([np.where(b == BINS, 0.0, np.exp(-(b + 0.5) / STEP)) for b in (rest // (BINS + 1), rest % (BINS + 1))] + [np.full(len(cells), p0)], axis=1)

    def fit(rows: np.ndarray, w: np.ndarray, prior: np.ndarray | None) -> np.ndarray:
        for _ in range(rounds):
            share = p[rows] * w
            total = (share * (n[rows] / share.sum(1))[:, None]).sum(0) + (10 * prior if prior is not None else 1e-6)
            w = total / total.sum()
        return w

    pooled = np.array([0.5, 0.4, 0.1])
    if len(cells):
        pooled = fit(np.ones(len(cells), bool), pooled, None)
    unseen = np.array([0.0, *pooled[1:] / pooled[1:].sum()])  # after a word that never occurred no bigram is possible
    prior = [unseen if b == 0 else pooled for b in range(BUCKETS)]
    return np.array([fit(bucket == b, prior[b], prior[b]) if (bucket == b).any() else prior[b] for b in range(BUCKETS)])


def score(docs: DataFrame, modulus: int = 7, held_out: int = 2) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, mean_score (a token).

    Tokens are the words of the whole text (A-Z in lower case), then one end. Counts come from documents whose
    crc32(doc_id as text) mod modulus isn't held_out. score is the base-10 logarithm of the product of
    w2 * c(v w) / c(v) + w1 * c(w) / N + w0 / (V + 1), v the token before (an end, at the start), with weights by the
    power of two of c(v). They are learned by expectation-maximisation on a sixth of the training documents with counts
    of the others; the scores then use the counts of all.

    Counting is a shuffle of packed n-grams: documents form chunks of a bounded size, written once; each chunk sends its
    distinct n-grams with counts to shards (ranges of hashes, as many as the input needs), and each shard returns totals
    to the chunks that asked. A frequent n-gram is one entry a chunk, so no key gathers rows. The driver holds N, V and a
    histogram of bounded size.

    Nulls: a null text is empty: one token, the end; a null doc_id has crc32 0. Repeated rows are counted and scored
    each. Without training documents the score is that of the uniform part. An empty table yields no rows."""
    spark = docs.sparkSession
    chunks = cut(chunked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), modulus, held_out), "chunks")

    def tally(batches):
        for t in batches:
            d = [np.frombuffer(c, np.int64).reshape(-1, 4) for c in t.column("c").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([int(x[x[:, 3] == u, 2].sum()) for x in d], pa.int64()) for u in range(3)], ["scored", "counted", "weighed"])

    sums = chunks.mapInArrow(tally, "scored long, counted long, weighed long").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("scored", "counted", "weighed")]).first()
    shards = max(1, -(-sum(sums) // SHARD_ENTRIES))
    answers = cut(answered(asked(chunks, shards)), "counts")
    found = [np.frombuffer(r["a"], np.int64) for r in answers.where(F.col("kind") == FOUND).select("a").toLocalIterator()]
    n, n_counted = sums["counted"] + sums["weighed"], sums["counted"]
    v, v_counted = (sum(int(x[i]) for x in found) for i in (0, 1))
    joined = chunks.unionByName(answers.where(F.col("kind") != FOUND))
    seen = evidence(joined.where("chunk % 2 = 1"), n_counted).toPandas().sort_values("cell") if n_counted else pd.DataFrame({"cell": [], "n": []}, dtype="int64")
    weights = learn_weights(seen["cell"].to_numpy(np.int64), seen["n"].to_numpy(np.float64), 1 / (v_counted + 1)) if n else np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        one, uni, bi, before = looked_up(pdf)
        c, pair, context = uni[0] + uni[1], bi[0] + bi[1], before[0] + before[1]
        w = weights[bucket_of(context)]
        p = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * c / max(n, 1) + w[:, 2] / (v + 1)
        begin = np.cumsum(one.docs[:, 2]) - one.docs[:, 2]
        each = lambda x: np.add.reduceat(x, begin)
        return pd.DataFrame(
            {
                "doc_id": pd.array(np.where(one.docs[:, 1] == 1, None, one.docs[:, 0]), "Int64"), "held_out": one.docs[:, 3] == SCORED, "n_tokens": one.docs[:, 2], "n_known": each((c > 0).astype(np.int64)),
                "train_tokens": n, "base_score": each(np.log10((c + 1) / (n + (v + 1)))), "score": each(np.log10(p)), "mean_score": each(np.log10(p)) / one.docs[:, 2],
            }
        )

    return joined.groupBy("chunk").applyInPandas(work, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, mean_score double")
