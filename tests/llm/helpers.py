"""Small tables with what the operators have to stand: nulls, empty and long texts, repeated rows, ties, odd columns."""

import random

import pandas as pd

SYLLABLES = "th an er in on re st ea ou ti ha nd es or le ve".split()
#: Names that operators use inside, as extra columns of an input.
CLASHING = ["bucket", "size", "kept", "key", "rep", "target", "root", "node", "n", "line", "h", "count", "copies"]


def sentence(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def texts(seed=1, families=6, copies=5):
    """Families of near copies at several distances, and the awkward cases."""
    rng = random.Random(seed)
    out = [None, "", " \n\t", "one two three", "One two  three", "a b c d", "x", "x", "Ünïcode ça va\nİstanbul ı", "same same same same same same"]
    for f in range(families):
        base = [sentence(rng, rng.randint(8, 30)) for _ in range(rng.randint(2, 6))]
        out.append("\n".join(base))
        for _ in range(copies):
            words = "\n".join(base).split(" ")
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                words[rng.randrange(len(words))] = rng.choice(SYLLABLES) + "q"
            out.append(" ".join(words))
    long = sentence(rng, 3000)
    return [*out, long, long + " end"]


def documents(spark, rows=None, extra=True):
    """doc_id, text, lang, source, n_chars; with a null id, a repeated row and columns of clashing names."""
    if rows is None:
        rows = [(i, t) for i, t in enumerate(texts())]
        rows += [(None, "no id here at all, my friends"), rows[12], (rows[12][0], rows[12][1])]
    data = [(i, t, ["en", "fr", None][k % 3], ["a", "a", "b", None][k % 4], None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("clash") for c in CLASHING if c not in df.columns})
    return df


def empty(spark):
    return documents(spark).where("false")


def rows_of(df):
    """Rows as a sorted list, nulls first."""
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in df.collect()), key=lambda r: [(v is not None, v) for v in r])


class Sets:
    """Union-find over hashable nodes."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
