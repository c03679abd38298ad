"""Every named query against its SQL on the smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from oracle import connect, differences

import __spark_entry__ as entry_points
from affinary.catalog import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, connection, name):
    problems = differences(QUERIES[name](spark, SF_DIR), connection, ORACLE[name])
    assert [p for p in problems if p.startswith("!")] == []


SPANNED = [
    "offline_evaluation",
    "top_items_per_user",
    "training_batches",
    "upsample_negatives",
]


@pytest.mark.parametrize("name", SPANNED)
def test_large_table_paths_match_sql(monkeypatch, spark, connection, name):
    """The same results when groups are cut into small spans."""
    monkeypatch.setattr("affinary.operators.ranking.SPAN_BITS", 3)
    problems = differences(QUERIES[name](spark, SF_DIR), connection, ORACLE[name])
    assert [p for p in problems if p.startswith("!")] == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_has_rows(spark, name):
    assert not QUERIES[name](spark, SF_DIR).isEmpty()


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).count() > 0


def test_entry_points_without_the_optional_part(tmp_path):
    """Without the operators for training data everything else still imports, the pipeline's file present or not."""
    root = Path(entry_points.__file__).resolve().parent
    skipped = shutil.ignore_patterns("llm", "__pycache__", ".git", ".pytest_cache")
    shutil.copytree(root, tmp_path / "copy", ignore=skipped)
    code = "import __spark_entry__ as e; names = set(e.queries()); print(len(names), any(n.startswith('op') and n[2:3].isdigit() for n in names), 'pipeline' in names)"
    for pipeline in (True, False):
        if not pipeline:
            (tmp_path / "copy" / "corpus_pipeline.py").unlink()
        told = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, check=True).stdout
        assert told.split() == [str(len(QUERIES)), "False", "False"]
