import zlib

import numpy as np
from helpers import documents, empty
from pyspark.sql import functions as F

from tidemark.llm import language


def test_held_out_accuracy(spark, sf_dir):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in df.select("doc_id", "lang").collect()}
    rows = language.identify(df, sample_rows=400).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and {r["lang_pred"] for r in rows} <= {*truth.values()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97


def test_lang_and_source_of_a_document_dont_matter(spark):
    rows = [(i, "the cat and the dog are here" if i % 2 else "le chat et les chiens sont ici") for i in range(60)]
    a, b = documents(spark, rows), documents(spark, rows)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lang = F.when(F.col("doc_id") % 2 == 1, "en").otherwise("fr")
    one = language.identify(a.withColumn("lang", lang)).collect()
    two = language.identify(b.withColumn("lang", F.when(held, "xx").otherwise(lang)).withColumn("source", F.lit("q"))).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))
    assert all(r["lang_pred"] == ("en" if r["doc_id"] % 2 else "fr") for r in one)


def test_undetermined(spark):
    rows = [(1, None), (2, ""), (3, "123 !?"), (6, "² ³ ½ ① Ⅷ"), (7, "\U0001f600 \U0001f680"), (None, "le mot"), (4, "the word"), (4, "the word")]
    got = language.identify(documents(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["lang_pred"]) for r in got if r["doc_id"] in (1, 2, 3, 6, 7)) == [(x, "und") for x in "12367"]
    assert len(got) == 8 and language.identify(empty(spark)).count() == 0
    none = documents(spark, rows).drop("lang").selectExpr("*", "cast(null as string) lang")
    assert {r["lang_pred"] for r in language.identify(none).collect()} == {"und"}


def test_families():
    assert language.family_of("en-GB") == language.family_of("de") != language.family_of("fr")
    assert language.family_of("xx") == "xx"


def test_many_values_of_lang_stay_within_the_bounds(spark):
    rows = [(i, f"some text {i} of words") for i in range(900)] + [(5000 + i, "the same row") for i in range(300)]
    df = documents(spark, rows).withColumn("lang", F.when(F.col("doc_id") < 300, F.concat(F.lit("x"), F.col("doc_id").cast("string"))).when(F.col("doc_id") < 600, "en").otherwise("fr"))
    got = language.identify(df, sample_rows=60, most_languages=10).collect()
    assert len(got) == 1200 and len({r["lang_pred"] for r in got}) <= 10


def test_predictions_equal_a_plain_version(spark):
    rng = np.random.default_rng(3)
    model = language.Model([(lang, *(x.tobytes() for x in language.features(t))) for lang, t in [("en", "the house and the cat"), ("de", "das haus und die katze"), ("fr", "la maison et le chat"), ("es", "la casa y el gato"), ("xx", "zzz qqq")] for t in (t, t + " " + t[:7])])
    assert model.families == ["germanic", "romance", "xx"] and model.pairs == [("de", "en"), ("es", "fr")]
    for t in ["the cat", "die katze", "le chat", "el gato", "zzz", "".join(rng.choice(list("abcdefg "), 40))]:
        at, v = language.features(t)
        x = np.zeros(1 << language.DIM_BITS)
        x[at] = v
        margin = [x @ model.weights[:, i] + model.bias[i] for i in range(5)]
        family = model.families[int(np.argmax(margin[:3]))]
        lang = {"germanic": ("de", "en")[int(margin[3] < 0)], "romance": ("es", "fr")[int(margin[4] < 0)], "xx": "xx"}[family]
        assert model.predict(t)[0] == lang
