"""Registered queries: SQL where there is some, the pipeline stage by stage, and the package without this part."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from pedalgrid.llm.queries import ORACLE, QUERIES
from pedalgrid.llm.common import table

FOLDER = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]


def test_one_query_per_operator():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert "pipeline" in contract.queries() and set(ORACLE) <= set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    theirs = connection.execute(ORACLE[name])
    columns = sorted(d[0] for d in theirs.description)
    theirs = theirs.df()[columns].values.tolist()
    ours = [[r[c] for c in columns] for r in QUERIES[name](spark, FOLDER).collect()]
    assert sorted(map(str, ours)) == sorted(map(str, theirs))


def test_stages_hand_on_what_they_keep(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    columns, ids = docs.columns, None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        now = [r["doc_id"] for r in docs.collect()]
        assert len(now) == len(set(now)) > 100
        assert ids is None or set(now) <= ids
        ids = set(now)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    run = corpus_pipeline.run(spark, FOLDER)
    assert {r["doc_id"] for r in run.collect()} == ids


def test_the_rest_works_without_this_part(tmp_path):
    """A copy of the repository without the subpackage, its tests and the pipeline still registers the other queries."""
    import shutil

    for part in ("pedalgrid", "verification"):
        shutil.copytree(REPO / part, tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op1_') for n in q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout.split()[1:] == ["False", "False", "True"]
