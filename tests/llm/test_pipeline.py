import subprocess
import sys
from pathlib import Path

import corpus_pipeline as P
import duckdb
import pytest
from helpers import documents, empty

from tidemark.llm import queries

ROOT = Path(__file__).resolve().parents[2]


def test_stages_keep_columns_and_act(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes], name
        docs = P.cut(out, "test")
        sizes.append(docs.count())
    assert sizes[1] < sizes[0] and sizes[2] <= sizes[1]
    packed = P.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_run_equals_its_stages(spark, sf_dir):
    docs = P.table(spark, sf_dir, "documents")
    for _, stage in P.STAGES:
        docs = P.cut(stage(spark, docs, sf_dir), "test")
    assert sorted(map(str, docs.collect())) == sorted(map(str, P.run(spark, sf_dir).collect()))


def test_every_stage_stands_odd_rows_and_empty_tables(spark, sf_dir):
    for name, stage in P.STAGES:
        assert stage(spark, empty(spark), sf_dir).count() == 0, name
        stage(spark, documents(spark), sf_dir).count()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_their_sql(spark, sf_dir, duck, name):
    from compare import same

    sql = duck.sql(queries.oracle_sql()[name]).df()
    same(queries.queries()[name](spark, sf_dir).toPandas()[sql.columns], sql)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_run(spark, sf_dir, name):
    assert queries.queries()[name](spark, sf_dir).count() > 0


def test_entry_works_without_this_package(tmp_path):
    for p in ("__spark_entry__.py", "tidemark"):
        subprocess.run(["cp", "-r", str(ROOT / p), str(tmp_path)], check=True)
    subprocess.run(["rm", "-r", str(tmp_path / "tidemark/llm")], check=True)
    code = "import __spark_entry__ as e; assert not [n for n in e.queries() if n.startswith('op') or n == 'pipeline']; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path), "HOME": "/tmp"})


def test_all_ten_are_registered():
    names = {n.split("_")[0] for n in queries.queries()}
    assert names == {f"op{i}" for i in range(1, 11)}
    assert duckdb is not None
