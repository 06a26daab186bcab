"""Near-duplicate documents by SetSketch registers, banding, likelihood and exact verification."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, cut, lower_words, mix64, odd_numbers, shingle_set
from .components import components
from .pairs import across, beside_first, verified, with_centre

#: SetSketch: base of the register scale, rate of the exponential variables, largest register value.
BASE, RATE, MOST = 1.001, 20.0, 65_535
#: Registers in a band and bands: documents at a similarity of 0.8 share no band with a probability of 1e-5, at 0.85 of
#: 4e-8, while those at 0.25 share one with 3e-3.
BAND, BANDS = 7, 48
#: Candidates with a likelihood estimate below similarity - SLACK aren't verified: seven standard deviations.
SLACK = 0.155
#: Lowest bits of registers, in 64-bit words: unequal registers differ in them half the time. Of 320 bits 32 differ at a
#: similarity of 0.8, with a deviation of 5.4; pairs across components with more than FEW_BITS differing (six deviations)
#: are dropped before their shingles are looked at.
BIT_WORDS, FEW_BITS = 5, 68
WORDS = tuple(f"w{i}" for i in range(BIT_WORDS))
GRID = np.linspace(0.0, 1.0, 101)


def registers(s: np.ndarray, m: int = BAND * BANDS) -> np.ndarray:
    """SetSketch registers of a set of hashes: each is the floor of 1 - log_b of the least of exponential variables, one
    for every element, cut off at 0 and MOST. Registers of a union are the larger ones of its parts."""
    x, a = odd_numbers(m, 11).astype(np.uint32)[:, None], (odd_numbers(m, 12) >> np.uint64(31)).astype(np.uint32)[:, None] | np.uint32(1)
    h, least = (s >> np.uint64(32)).astype(np.uint32)[None, :], np.full(m, 2**32 - 1, np.uint32)
    for i in range(0, len(s), 512):
        v = h[:, i : i + 512] ^ x
        v *= a
        np.minimum(least, v.min(1), out=least)
    e = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(np.maximum(e, 1e-300)) / math.log(BASE)), 0, MOST).astype("<u2")


def bands(r: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of registers; keys of different bands differ."""
    h = np.full(BANDS, 0x51, np.uint64) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for col in r.reshape(BANDS, BAND).T.astype(np.uint64):
        h = mix64(h ^ (col + np.uint64(1)))
    return h.view(np.int64)


def low_bits(r: np.ndarray) -> np.ndarray:
    """BIT_WORDS words of the lowest bits of registers."""
    return np.packbits((r[: 64 * BIT_WORDS] & 1).astype(np.uint8)).view(np.int64)


def likely(na: np.ndarray, nb: np.ndarray, ra: np.ndarray, rb: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood estimate of the Jaccard similarity from set sizes and how many registers are larger in
    the one, in the other, or equal, over a grid."""
    more, less = (ra > rb).sum(1)[:, None], (ra < rb).sum(1)[:, None]
    same = ra.shape[1] - more - less
    u = (na / (na + nb))[:, None]
    v = 1 - u
    j = np.minimum(GRID[None, :], np.minimum(u / v, v / u))  # no larger similarity is possible

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    up, down = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    ll = more * np.log(np.maximum(up, tiny)) + less * np.log(np.maximum(down, tiny)) + same * np.log(np.maximum(1 - up - down, tiny))
    return j[np.arange(len(j)), ll.argmax(1)]


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, doc (hash of the text), n_shingles, key (of the set; null if it is empty), bands, registers, bits."""

    def work(batches):
        hashes = WordHashes()
        for b in batches:
            texts = b.column(1)
            for i in range(0, b.num_rows, 500):
                rows = []
                for t in texts.slice(i, 500):
                    s = shingle_set(hashes.of(lower_words(t.as_py())), k)
                    if len(s):
                        r = registers(s)
                        rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), bands(r), r.tobytes(), low_bits(r)))
                    else:
                        rows.append((0, None, None, None, None))
                types = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 500), b.column(2).slice(i, 500), *columns], ["doc_id", "doc", "n_shingles", "key", "bands", "registers", "bits"])

    return docs.select("doc_id", "text", "doc").mapInArrow(work, "doc_id long, doc long, n_shingles long, key binary, bands array<long>, registers binary, bits array<long>")


def near_enough(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of class representatives whose sizes and likelihood estimate allow for a link."""
    size = classes.select("rep", F.col("n_shingles").alias("n"), "registers")
    a, b = (size.select(*[F.col(c).alias(f"{c}_{s}") for c in size.columns]) for s in "ab")
    both = pairs.join(a, F.col("a") == F.col("rep_a")).join(b, F.col("b") == F.col("rep_b")).where((100 * F.col("n_a") >= percent * F.col("n_b")) & (100 * F.col("n_b") >= percent * F.col("n_a")))
    least = percent / 100 - SLACK

    def estimate(batches):
        for t in batches:
            if not t.num_rows:
                continue
            n = [t.column(c).to_numpy().astype(np.float64) for c in ("n_a", "n_b")]
            r = [np.frombuffer(b"".join(t.column(c).to_pylist()), "<u2").reshape(t.num_rows, -1) for c in ("registers_a", "registers_b")]
            keep = np.concatenate([likely(*(x[i : i + 1000] for x in (*n, *r))) for i in range(0, t.num_rows, 1000)]) >= least
            yield t.select(["a", "b"]).filter(pa.array(keep))

    return cut(both.select("a", "b", "n_a", "n_b", "registers_a", "registers_b").mapInArrow(estimate, "a long, b long"), "close")


def whole_sets(named: DataFrame, classes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """id, s: the whole shingle sets of named classes (column rep), each read from its first document. Of rows that repeat
    that document's id and text one is read."""
    named = named.distinct().join(classes.select("rep", F.col("first.doc_id").alias("doc_id"), F.col("first.doc").alias("doc"), "rows"), "rep")

    def sets(batches):
        hashes = WordHashes()
        for t in batches:
            for i in range(0, t.num_rows, 500):
                got = [shingle_set(hashes.of(lower_words(x.as_py())), k).tobytes() for x in t.column(1).slice(i, 500)]
                yield pa.RecordBatch.from_arrays([t.column(0).slice(i, 500), pa.array(got, pa.binary())], ["id", "s"])

    texts = docs.join(named, ["doc_id", "doc"]).select("rep", "text", "rows")
    once = texts.where("rows = 1").unionByName(texts.where("rows > 1").dropDuplicates(["rep"]))
    return cut(once.select("rep", "text").mapInArrow(sets, "id long, s binary"), "sets")


def own_shingles(whole: DataFrame) -> DataFrame:
    """id, own: how many shingles of each set no other of these sets has. They are in no intersection."""

    def spread(batches):
        for t in batches:
            for i, s in zip(t.column(0).to_pylist(), t.column(1), strict=True):
                h = np.frombuffer(s.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), i, np.int64)), pa.array(h)], ["id", "h"])

    once = whole.mapInArrow(spread, "id long, h long").groupBy("h").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1")
    return once.groupBy("id").agg(F.count("*").alias("own"))


def linked_classes(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of docs (doc_id, text, doc): the table of sketch(); classes of equal sets (rep, a number; key; first, the least of
    (doc_id, doc); and more); and roots (node, root) of the classes that are linked with another. See near_duplicates()."""
    rows = cut(sketch(docs, k), "sketches")
    known = rows.where("key is not null and doc_id is not null")
    first = known.groupBy("key").agg(F.min(F.struct("doc_id", "doc")).alias("first"), *[F.any_value(c).alias(c) for c in ("n_shingles", "bands", "registers", "bits")], F.count("*").alias("rows"))
    classes = cut(first.withColumn("rep", F.monotonically_increasing_id()), "classes")  # fixed once it is written
    members = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a < last").select("bucket")
    members = cut(with_centre(cut(members.join(shared, "bucket"), "members"), "rep"), "members")
    star = members.where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    close = near_enough(star, classes, percent)
    links = verified(close, whole_sets(close.select(F.explode(F.array("a", "b")).alias("rep")), classes, docs, k), percent)
    roots = cut(components(links), "roots")

    placed = members.join(roots, members["rep"] == roots["node"], "left").select("bucket", "a", "rep", F.coalesce("root", "rep").alias("root"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("members")).where("lo < hi").select("bucket", "members")
    mixed = cut(placed.join(mixed, "bucket"), "mixed")
    whole = whole_sets(mixed.select("rep"), classes, docs, k)
    own = own_shingles(whole)
    able = classes.select("rep", F.col("n_shingles").alias("n"), *[F.col("bits")[i].alias(w) for i, w in enumerate(WORDS)]).join(whole.select(F.col("id").alias("rep")), "rep", "left_semi").join(own.withColumnRenamed("id", "rep"), "rep", "left")
    able = able.select("rep", "n", *WORDS, (F.col("n") - F.coalesce("own", F.lit(0))).alias("common")).where(100 * F.col("common") >= percent * F.col("n"))
    placed = cut(mixed.join(able, "rep"), "placed")
    beside = beside_first(placed.select("a", "rep").distinct(), whole)
    placed = placed.drop("n").join(beside, ["a", "rep"]).drop("a")
    placed = cut(placed, "placed-beside")
    main = placed.groupBy("bucket", "root").count().groupBy("bucket").agg(F.max_by("root", F.struct("count", "root")).alias("main"))
    rest = across(placed.join(main, "bucket").where("root <> main"), placed, percent, WORDS, FEW_BITS).distinct().join(star, ["a", "b"], "left_anti")
    more = verified(near_enough(cut(rest, "rest"), classes, percent), whole, percent)
    if not more.isEmpty():
        roots = cut(components(links.unionByName(more)), "roots")
    return rows, classes, roots


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links), kept, class_id.

    Two documents are linked if their sets of distinct k-word shingles (A-Z in lower case) share percent of their union.
    1. One pass makes SetSketch registers, 7 to a band, and a key of the set. Equal sets form a class, whose smallest id
       stands for it from here on. 2. In each bucket of equal bands every class is paired with its centre; sizes and the
       likelihood estimate drop what can't be near; whole shingle sets decide. 3. Components of these links. 4. Where
       a bucket still holds several components, the pairs across them are decided too: shingles that no other member has, and
       those of the bucket's centre that a member has, bound what two can have in common, which rules out nearly all
       that aren't linked; the others are verified in the same way, so no link is lost to step 2, and components are formed anew. A group of copies thus costs one pair a member, not one for each two.

    Hot groups: classes and bucket minima are aggregated before the shuffle; joins have the small side unique by key, so
    that Spark splits the large one. Bands miss a pair at 0.8 with a probability of 1e-5, less above. Whole sets are
    compared by 53 bits of each shingle's hash, classes by 128.

    Nulls: a null text, or one without words, has an empty set and is linked with nothing; a row without doc_id is linked
    with nothing, its component_id is null and it is kept. Repeated rows share a class. Rows that repeat an id with other
    texts are one document with several sets: links of each are its links, and all its rows with words get one
    component_id. An empty table yields no rows. Texts of any length are read whole."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("doc"))
    rows, classes, roots = linked_classes(docs, k, percent)
    known = rows.where("key is not null and doc_id is not null")
    several = known.groupBy("doc_id").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo <> hi").select("doc_id")
    several = cut(known.select("doc_id", "key").join(several, "doc_id").distinct().join(classes.select("key", "rep"), "key").select("doc_id", "rep"), "several")
    if not several.isEmpty():  # classes that share an id are linked through it
        through = several.join(several.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id").where("rep <> a").select("a", F.col("rep").alias("b"))
        roots = cut(components(through.unionByName(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).where("a <> b"))), "roots")
    roots = classes.select("key", "rep", "first.doc_id").join(roots, F.col("rep") == F.col("node"), "left").select("key", F.coalesce("root", "rep").alias("root"), "doc_id")
    least = roots.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = roots.join(least, "root").select("key", F.col("doc_id").alias("class_id"), "component_id")
    alone = F.col("key").isNull() | F.col("doc_id").isNull()  # apart from the join, where nulls would meet in one task
    out = rows.where(~alone).join(named, "key").select("doc_id", "n_shingles", "component_id", "class_id")
    out = out.unionByName(rows.where(alone).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "class_id")


def without_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns, with one row of each group of linked sets: that with the smallest id and, of equal
    ids, the smallest hash of the text. Rows without id and rows without words all stay. Here an id links nothing: rows that
    repeat an id with other texts are apart unless these are near. An empty table yields no rows."""
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__doc": F.xxhash64("text")})
    rows, classes, roots = linked_classes(keyed.select(F.col("__id").alias("doc_id"), "text", F.col("__doc").alias("doc")), k, percent)
    group = classes.select("rep", "first", "rows").join(roots, F.col("rep") == F.col("node"), "left").groupBy(F.coalesce("root", "rep").alias("root"))
    kept = cut(group.agg(F.min(F.struct("first", "rows")).alias("best")).select(F.col("best.first.doc_id").alias("__id"), F.col("best.first.doc").alias("__doc"), F.col("best.rows").alias("__rows")), "kept")
    found = keyed.join(kept, ["__id", "__doc"])
    found = found.where("__rows = 1").unionByName(found.where("__rows > 1").dropDuplicates(["__id", "__doc"])).select(docs.columns)
    empty = rows.where("key is null and doc_id is not null").select(F.col("doc_id").alias("__id"), F.col("doc").alias("__doc")).distinct()
    return found.unionByName(keyed.join(empty, ["__id", "__doc"], "left_semi").select(docs.columns)).unionByName(docs.where("doc_id is null"))
