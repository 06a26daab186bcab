"""Language identification: families first, then one-versus-one linear support vector machines within the family."""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, id_crc_column

DIM_BITS = 14
UNKNOWN = "und"

#: Families of languages by ISO 639-1 code (fixed values); any other language is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy lb af".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be bg mk sr hr bs sl cs sk pl".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky".split(),
}


def family_of(lang: str) -> str:
    code = re.split(r"[-_]", lang.lower())[0]
    return next((f for f, codes in FAMILIES.items() if code in codes), lang)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters; fractions, circled numbers, Roman numerals and emoji aren't."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sparse unit vector: square roots of the counts of hashed 1- to 4-letter sequences of the whole text, with word
    edges; anything but letters is an edge. Empty without a letter."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[code]
    if not is_letter.any():
        return np.empty(0, np.int32), np.empty(0, np.float32)
    x = np.concatenate(([0], np.where(is_letter, code, 0), [0])).astype(np.uint32)
    x = x[np.concatenate(([True], (x[1:] != 0) | (x[:-1] != 0)))]
    total, h = np.zeros(1 << DIM_BITS, np.int64), x * np.uint32(0x9E3779B1)
    for n in range(1, 5):
        if n > 1:
            if len(x) < n:
                break
            h = (h[:-1] * np.uint32(0x85EBCA6B)) ^ ((x[n - 1 :] + np.uint32(n)) * np.uint32(0xC2B2AE35))
        total += np.bincount((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - DIM_BITS), minlength=1 << DIM_BITS)
    at = np.flatnonzero(total)
    v = np.sqrt(total[at]).astype(np.float32)
    return at.astype(np.int32), v / np.sqrt((v * v).sum())


def machine(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 15, seed: int = 7) -> np.ndarray:
    """Weights (the last is the bias) of a linear support vector machine, by dual coordinate descent on the squared hinge
    loss; the smaller side weighs as much as the larger. Rows of x end with a constant."""
    rng, w = np.random.default_rng(seed), np.zeros(x.shape[1], np.float32)
    alpha, norm = np.zeros(len(y)), (x * x).sum(1)
    cost = np.where(y > 0, c * len(y) / (2 * max((y > 0).sum(), 1)), c * len(y) / (2 * max((y < 0).sum(), 1)))
    for _ in range(rounds):
        for i in rng.permutation(len(y)):
            d = 1 / (2 * cost[i])
            new = max(0.0, alpha[i] - (y[i] * float(x[i] @ w) - 1 + d * alpha[i]) / (norm[i] + d))
            if new != alpha[i]:
                w += np.float32((new - alpha[i]) * y[i]) * x[i]
                alpha[i] = new
    return w


class Model:
    """One machine per family against the others, and one for each two languages of a family."""

    def __init__(self, rows: list[tuple[str, bytes, bytes]]):
        langs = np.array([r[0] for r in rows], object)
        self.languages = sorted(set(langs))
        self.family = {}
        for lang in self.languages:
            self.family.setdefault(family_of(lang), []).append(lang)
        self.families = sorted(self.family)
        x = np.zeros((len(rows), (1 << DIM_BITS) + 1), np.float32)
        for i, (_, at, v) in enumerate(rows):
            x[i, np.frombuffer(at, np.int32)] = np.frombuffer(v, np.float32)
        x[:, -1] = 0.3
        weights, self.pairs = [], []
        families = np.array([family_of(lang) for lang in langs], object)
        if len(self.families) > 1:
            weights += [machine(x, np.where(families == f, 1.0, -1.0)) for f in self.families]
        for f in self.families:
            for a, b in combinations(self.family[f], 2):
                of = (langs == a) | (langs == b)
                self.pairs.append((a, b))
                weights.append(machine(x[of], np.where(langs[of] == a, 1.0, -1.0)))
        w = np.array(weights, np.float32).reshape(-1, (1 << DIM_BITS) + 1)
        self.weights, self.bias = np.ascontiguousarray(w[:, :-1].T), w[:, -1] * np.float32(0.3)

    def predict(self, text: str | None) -> tuple[str, float]:
        at, v = features(text)
        if not len(at) or not self.languages:
            return UNKNOWN, 0.0
        m = v @ self.weights[at] + self.bias
        sure, n = 1.0, len(self.families) if len(self.families) > 1 else 0
        best = int(np.argmax(m[:n])) if n else 0
        if n:
            sure = 1 / (1 + np.exp(-4.0 * m[best]))
        among = self.family[self.families[best]]
        votes, margin = dict.fromkeys(among, 0), dict.fromkeys(among, 0.0)
        for (a, b), d in zip(self.pairs, m[n:].tolist(), strict=True):
            if a in votes and b in votes:
                votes[a if d >= 0 else b] += 1
                margin[a] += d
                margin[b] -= d
        lang = max(among, key=lambda x: (votes[x], margin[x]))
        if len(among) > 1:
            sure *= 1 / (1 + np.exp(-4.0 * margin[lang] / (len(among) - 1)))
        return lang, float(min(1.0, max(0.0, sure)))


def learn(docs: DataFrame, sample_rows: int, most_languages: int) -> Model:
    """A model of at most sample_rows documents, as many of each of the most_languages commonest languages: those with the
    lowest hashes. Only features of that documented number of rows reach the driver."""
    common = docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(min(most_languages, sample_rows // 2)).collect()
    each = min(1000, sample_rows // max(len(common), 1))
    # A language's lowest hashes are among those below a share of all that holds a few times as many, so that a common
    # language sends a bounded number of rows to the task that orders them.
    shares = [(r["lang"], min(1.0, (4 * each + 200) / r["count"])) for r in common]
    shares = docs.sparkSession.createDataFrame(shares, "lang string, share double")
    hashed = docs.withColumn("h", F.xxhash64("doc_id", "text"))
    low = hashed.join(F.broadcast(shares), "lang").where(F.shiftrightunsigned("h", 11) / F.lit(2.0**53) < F.col("share")).select("lang", "h").distinct()
    chosen = low.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("r") <= each).select("lang", "h")
    # Texts of the chosen hashes follow, one of rows that are equal.
    picked = hashed.join(F.broadcast(cut(chosen, "sample")), ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")

    def work(batches):
        for b in batches:
            found = [features(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([a.tobytes() for a, _ in found], pa.binary()), pa.array([v.tobytes() for _, v in found], pa.binary())], ["lang", "at", "v"])

    rows = picked.mapInArrow(work, "lang string, at binary, v binary").collect()
    return Model(sorted((r["lang"], bytes(r["at"]), bytes(r["v"])) for r in rows if len(r["at"])))


def identify(docs: DataFrame, modulus: int = 5, held_out: int = 0, sample_rows: int = 2400, most_languages: int = 100) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score (0 to 1).

    Learns from text and lang of documents whose crc32(doc_id as text) mod modulus isn't held_out, from a bounded sample
    of sample_rows documents (at least 2 and at most 1,000 a language) in the most_languages commonest languages: rarer values
    of lang are never predicted. A prediction reads the whole text and nothing
    else. The weights go to the executors with the code: 64 KB for each machine.

    Nulls: a null text, or one without a letter, is `und` with score 0; a null lang isn't learned from; a null doc_id has
    crc32 0. Without any labelled text all are `und`. Repeated rows are predicted alike. An empty table yields no rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    held = id_crc_column(F.col("doc_id")) % modulus == held_out
    model = learn(rows.where(~held & F.col("lang").isNotNull() & F.col("text").isNotNull()), sample_rows, most_languages)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for b in batches:
            got = [shared.value.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return rows.select("doc_id", "text", held.alias("held_out")).mapInArrow(work, "doc_id long, held_out boolean, lang_pred string, score double")
