"""The thin queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import html_text, language, line_dedup, lm_score, mixing, near_dup, packing, pii, quality, topk
from .common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_address", "n_account")


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), k=4, percent=80).drop("class_id")


SQL2 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
g AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [md5(array_to_string(w, ' '))]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: md5(array_to_string(w[i:i + 3], ' ')))) END AS s
  FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS h FROM g),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb
      FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * c >= 80 * (na + nb - c)),
u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT u.b, r.root FROM r JOIN u ON u.a = r.doc_id WHERE r.root < u.b),
m AS (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id)
SELECT g.doc_id, CAST(len(g.s) AS BIGINT) AS n_shingles, m.root AS component_id, g.doc_id = m.root AS kept
FROM g JOIN m ON g.doc_id = m.doc_id
"""


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


SQL5 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path())


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_counts(table(spark, sf_dir, "documents", "doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_pii": op1_pii, "op2_near_dup": op2_near_dup, "op3_html": op3_html, "op4_lm_score": op4_lm_score, "op5_exact_topk": op5_exact_topk, "op6_quality": op6_quality, "op7_language": op7_language, "op8_packing": op8_packing, "op9_mixing": op9_mixing, "op10_line_dedup": op10_line_dedup}


def oracle_sql() -> dict[str, str]:
    return {"op2_near_dup": SQL2, "op5_exact_topk": SQL5}
