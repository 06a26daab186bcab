"""Quality rules: fixed base rules, and an isolation forest on rule statistics calibrated from labelled rows."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, words

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
SYMBOL = re.compile(rb"[#*$%&|<>]")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_symbol_words", "n_symbol_kinds"]
WINDOW = 5


def repeated_words(ws: list[bytes], k: int = WINDOW) -> int:
    """Words inside k-word windows that occur twice or more in the text, the first occurrence included."""
    n = len(ws)
    if n <= k:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in ws), np.int64, n)
    # a window's number is built pair by pair, each time numbered anew, so that different windows never share one
    number = ids[: n - k + 1]
    for i in range(1, k):
        number = np.unique(number * (len(seen) + 1) + ids[i : n - k + 1 + i], return_inverse=True)[1]
    twice = np.flatnonzero(np.bincount(number)[number] >= 2)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + k, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def counts_of(text: str | None) -> list[int]:
    """COUNTS of one whole text."""
    if not text:
        return [0] * len(COUNTS)
    ws = words(text)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    upper = int(((code >= 65) & (code <= 90)).sum())
    symbols = [text.count(c) for c in SYMBOLS]
    return [
        len(ws), len(text) - sum(text.count(c) for c in SPACES), sum(symbols), len(lines) - len(set(lines)), repeated_words(ws),
        len(lines), len(set(ws)), upper, int(((code >= 48) & (code <= 57)).sum()), sum(SYMBOL.search(w) is not None for w in ws) if any(symbols) else 0, sum(map(bool, symbols)),
    ]


def failed(c: np.ndarray) -> np.ndarray:
    """The base rules, on rows of COUNTS."""
    return (c[:, 0] < 10) | (100 * c[:, 4] > 20 * c[:, 0])


STATISTICS = ("symbols", "repeated lines", "repeated words", "capitals", "distinct words", "word length", "words with symbols", "kinds of symbols", "digits")


def features(c: np.ndarray) -> np.ndarray:
    """STATISTICS of rows of COUNTS, none of which depends on the length of an ordinary text."""
    n, ch, lines = np.maximum(c[:, 0], 1), np.maximum(c[:, 1], 1), np.maximum(c[:, 5], 1)
    return np.stack([np.sqrt(c[:, 2] / n), c[:, 3] / lines, c[:, 4] / n, c[:, 7] / ch, np.log(np.maximum(c[:, 6], 1)) / np.log(np.maximum(n, 2)), (c[:, 1] - np.minimum(c[:, 2], c[:, 1])) / n, c[:, 9] / n, c[:, 10] / len(SYMBOLS), c[:, 8] / ch], axis=1)


def mean_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def draws(n: int, trees: int, sample: int, seed: int) -> list[np.ndarray]:
    """For each tree, the numbers of its rows: min(sample, n) of 0..n-1, each equally likely and none twice."""
    rng = np.random.default_rng([seed, 1])
    return [rng.choice(n, min(sample, n), replace=False) for _ in range(trees)]


class IsolationForest:
    """Random splits isolate unusual rows after few steps: score 2 ** (-mean path / mean_path(sample)).

    A split is drawn over the part of the range lo..hi that is left at its node, not over the values of the rows there, so
    that a statistic that is constant among the rows can still tell others from them: they end in an empty branch."""

    def __init__(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray, trees: int = 100, sample: int = 256, limit: int = 20, seed: int = 6):
        self._grow_all([x[at] for at in draws(len(x), trees, sample, seed)], lo, hi, limit, seed)

    @classmethod
    def of_samples(cls, samples: list[np.ndarray], lo: np.ndarray, hi: np.ndarray, limit: int = 20, seed: int = 6) -> IsolationForest:
        """The forest whose trees are grown on these rows, one array a tree and all of one length."""
        forest = cls.__new__(cls)
        forest._grow_all(samples, lo, hi, limit, seed)
        return forest

    def _grow_all(self, samples: list[np.ndarray], lo: np.ndarray, hi: np.ndarray, limit: int, seed: int):
        rng, self.n, self.limit, self.wide = np.random.default_rng(seed), len(samples[0]), limit, np.flatnonzero(hi > lo)
        self.trees = [self._grow(x, lo, hi, rng) for x in samples]

    def _grow(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, cut_at, left, right, depth = [], [], [], [], []

        def node(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, level: int) -> int:
            me = len(feature)
            for part, v in ((feature, -1), (cut_at, 0.0), (left, me), (right, me), (depth, level + mean_path(len(rows)))):
                part.append(v)
            if level < self.limit and len(rows) > 1 and len(self.wide):
                f = int(rng.choice(self.wide))
                v = float(np.float32(rng.uniform(lo[f], hi[f])))
                feature[me], cut_at[me], goes = f, v, rows[:, f] <= v
                below, above = hi.copy(), lo.copy()
                below[f] = above[f] = v
                left[me], right[me] = node(rows[goes], lo, below, level + 1), node(rows[~goes], above, hi, level + 1)
            return me

        node(x, lo, hi, 0)
        return tuple(np.array(a, t) for a, t in zip((feature, cut_at, left, right, depth), (np.int8, np.float32, np.int32, np.int32, np.float32), strict=True))

    def score(self, x: np.ndarray) -> np.ndarray:
        total, every = np.zeros(len(x)), np.arange(len(x))
        for feature, cut_at, left, right, depth in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.limit):
                f = feature[at]
                if (f < 0).all():
                    break
                at = np.where(x[every, f] <= cut_at[at], left[at], right[at])  # a leaf is its own child
            total += depth[at]
        return 2.0 ** (-total / len(self.trees) / max(mean_path(self.n), 1e-9))


def rank_of(good_loss: float, n: int) -> int:
    """Of n good rows by score, the number (from 1) of the one that the threshold may not be below."""
    return max(1, math.ceil((1 - good_loss) * n))


class Verdict:
    """A forest on all statistics, and the score above which it rejects (None: it has no say)."""

    def __init__(self, labelled: list[tuple] = (), good_loss: float = 0.002):
        """From rows at hand, (quality, *COUNTS) each; fit() does the same for a table of any size."""
        rows = np.array([r[1:] for r in labelled], np.float64).reshape(-1, len(COUNTS))
        good = np.array([r[0] for r in labelled])[(ok := ~failed(rows))] == 1
        x = features(rows[ok])
        self.forest: IsolationForest | None = None
        if good.sum() < 2:
            return
        forest = IsolationForest(x[good], x.min(0), x.max(0))
        s = forest.score(x)
        most = np.sort(s[good])[rank_of(good_loss, int(good.sum())) - 1]
        self.settle(forest, most, min(s[~good & (s > most)], default=None))

    def settle(self, forest: IsolationForest, most: float, caught: float | None):
        """The threshold: the good row's score `most`, or half-way from it to the next score of a bad row."""
        self.forest, self.limit = forest, float(most) if caught is None else float(most + caught) / 2

    def judge(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(kept, anomaly) of rows of COUNTS; the anomaly is the forest's score, 0 without a forest."""
        kept = ~failed(counts)
        if self.forest is None or not len(counts):
            return kept, np.zeros(len(counts))
        score = self.forest.score(features(counts.astype(np.float64)))
        return kept & (score <= self.limit), score


def counted(texts) -> np.ndarray:
    """Rows of COUNTS of an Arrow column of texts."""
    return np.array([counts_of(t.as_py()) for t in texts], np.int64).reshape(-1, len(COUNTS))


def count(docs: DataFrame, name: str) -> DataFrame:
    """A table of doc_id, COUNTS and base_failed of all rows; every whole text is read once."""

    def work(batches):
        for b in batches:
            c = counted(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c[:, i]) for i in range(len(COUNTS))], pa.array(failed(c))], ["doc_id", *COUNTS, "base_failed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return cut(rows.mapInArrow(work, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean"), name)


def matrix(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns], axis=1) if batch.num_rows else np.zeros((0, len(columns)))


#: Columns of the statistics, and parts into which labelled rows fall by hash to be numbered.
X = [f"x{i}" for i in range(len(STATISTICS))]
BUCKETS = 4096
PLACE = ["quality", "m", "bucket", "upto"]


def labelled(counts: DataFrame, labels: DataFrame, sample_rows: int | None) -> DataFrame:
    """A table of all labelled rows that pass the base rules: quality, the number m of rows alike (with one doc_id and one
    set of COUNTS), X, and their place: the good ones of a bucket up to and with this one."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("long").alias("quality"))
    rows = counts.where("doc_id is not null and not base_failed").groupBy("doc_id", *COUNTS).agg(F.count(F.lit(1)).alias("m")).join(known, "doc_id")
    if sample_rows is not None:
        rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS).limit(sample_rows)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", *COUNTS), F.lit(BUCKETS)))
    good = F.when(F.col("quality") == 1, F.col("m")).otherwise(0)
    rows = rows.withColumn("upto", F.sum(good).over(Window.partitionBy("bucket").orderBy("doc_id", *COUNTS).rowsBetween(Window.unboundedPreceding, 0)))

    def work(batches):
        for b in batches:
            x = features(matrix(b, COUNTS).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in PLACE], *[pa.array(x[:, i]) for i in range(len(X))]], [*PLACE, *X])

    return cut(rows.select(*PLACE, *COUNTS).mapInArrow(work, ", ".join([f"{c} long" for c in PLACE] + [f"{c} double" for c in X])), "labelled")


def rows_at(rows: DataFrame, wanted: np.ndarray, start: np.ndarray) -> np.ndarray:
    """X of the good rows with the sorted numbers wanted; start: the number of each bucket's first."""
    sent = rows.sparkSession.sparkContext.broadcast((wanted, start))

    def work(batches):
        numbers, first = sent.value
        for b in batches:
            place = matrix(b, PLACE).astype(np.int64)
            end = first[place[:, 2]] + place[:, 3]
            since, until = np.searchsorted(numbers, end - place[:, 1]), np.searchsorted(numbers, end)
            hit = np.flatnonzero(until > since)
            yield pa.RecordBatch.from_arrays([pa.array(since[hit]), pa.array(until[hit]), *[b.column(c).take(pa.array(hit)) for c in X]], ["since", "until", *X])

    out = np.full((len(wanted), len(X)), np.nan)
    for r in rows.where("quality = 1").mapInArrow(work, "since long, until long, " + ", ".join(f"{c} double" for c in X)).collect():
        out[r[0] : r[1]] = r[2:]
    sent.unpersist()
    return out


def at_rank(scores: DataFrame, rank: int) -> int:
    """The bits of the rank-th lowest score (from 1), row by row m times: 16 bits a round, so that at most 65,536 sums
    reach the driver, however many rows there are. Scores are positive, so their bits have their order."""
    prefix, below = 0, 0
    for shift in (48, 32, 16, 0):
        part = scores if shift == 48 else scores.where(F.shiftright("bits", shift + 16) == F.lit(prefix))
        for prefix, m in sorted(map(tuple, part.groupBy(F.shiftright("bits", shift).alias("bin")).agg(F.sum("m")).collect())):
            if below + m >= rank:
                break
            below += m
    return prefix


def fit(counts: DataFrame, labels: DataFrame, sample_rows: int | None, good_loss: float):
    """The broadcast Verdict of all labelled rows of count(): what Verdict() does with rows at hand. The range of splits,
    the choice of the rows of each tree and the threshold are exact over all of them; to the driver come the rows that
    trees are grown on, the sums and ranges of BUCKETS parts, and the bins of at_rank()."""
    context = counts.sparkSession.sparkContext
    rows = labelled(counts, labels, sample_rows)
    good = F.sum(F.when(F.col("quality") == 1, F.col("m")).otherwise(0))
    parts = sorted(map(tuple, rows.groupBy("bucket").agg(good, *[F.min(c) for c in X], *[F.max(c) for c in X]).collect()))
    n = sum(p[1] for p in parts)
    if n < 2:
        return context.broadcast(Verdict())
    start = np.zeros(BUCKETS, np.int64)
    start[[p[0] for p in parts]] = np.cumsum([0] + [p[1] for p in parts])[:-1]
    edges = np.array([p[2:] for p in parts], np.float64)
    trees = draws(n, 100, 256, 6)
    wanted = np.unique(np.concatenate(trees))
    x = rows_at(rows, wanted, start)
    forest = IsolationForest.of_samples([x[np.searchsorted(wanted, t)] for t in trees], edges[:, : len(X)].min(0), edges[:, len(X) :].max(0))
    sent = context.broadcast(forest)

    def work(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("quality"), b.column("m"), pa.array(sent.value.score(matrix(b, X)).view(np.int64))], ["quality", "m", "bits"])

    scores = cut(rows.select("quality", "m", *X).mapInArrow(work, "quality long, m long, bits long"), "scores")
    most = at_rank(scores.where("quality = 1"), rank_of(good_loss, n))
    caught = scores.where((F.col("quality") != 1) & (F.col("bits") > F.lit(most))).agg(F.min("bits")).first()[0]
    number = lambda bits: None if bits is None else np.int64(bits).view(np.float64)
    verdict = Verdict()
    verdict.settle(forest, number(most), number(caught))
    sent.unpersist()
    return context.broadcast(verdict)


def judge(docs: DataFrame, labels: DataFrame, sample_rows: int | None = None, good_loss: float = 0.002) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, anomaly.

    One isolation forest on all STATISTICS is grown on labelled rows of quality 1 that pass the base rules, with splits
    over the range of all labelled rows. It rejects scores above a threshold that at most a share good_loss of these rows
    exceeds; the threshold stands half-way to the nearest row of quality 0 beyond. Range and threshold come from all
    labelled rows, and each tree takes the 256 rows of the method from all of them; sample_rows, where a caller sets it,
    leaves only so many different ones, those with the lowest hashes of doc_id. Every whole text is read once, into a
    table of its counts.

    Nulls: a null or empty text has no words and fails the base rules; a null doc_id is kept and never labelled; labels
    with a null in either column don't count, and of several labels of a document the lowest counts. Repeated rows are
    judged alike, and each counts towards the threshold. With fewer than two good labelled rows the base rules alone
    decide. Empty tables yield no rows."""
    counts = count(docs, "counts")
    verdict = fit(counts, labels, sample_rows, good_loss)

    def work(batches):
        for b in batches:
            kept, score = verdict.value.judge(matrix(b, COUNTS).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", *COUNTS[:5], "base_failed")], pa.array(kept), pa.array(score)], ["doc_id", *COUNTS[:5], "base_failed", "kept", "anomaly"])

    return counts.mapInArrow(work, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS[:5]) + ", base_failed boolean, kept boolean, anomaly double")


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int | None = None, good_loss: float = 0.002) -> DataFrame:
    """The rows of docs that judge() keeps, with all their columns; nulls, repeated rows and empty tables as there. Texts
    are counted once for the verdict and once more beside their other columns."""
    verdict = fit(count(docs, "counts"), labels, sample_rows, good_loss)
    at = docs.columns.index("text")

    def work(batches):
        for b in batches:
            yield b.filter(pa.array(verdict.value.judge(counted(b.column(at)))[0], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
