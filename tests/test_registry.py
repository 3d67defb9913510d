"""Every registered query against its SQL on the smallest driver tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("HOURGRID_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are absent")

QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()
# Queries of the optional corpus package have tests of their own.
CORPUS = {n for n in QUERIES if n == "pipeline" or n.startswith("op") and n[2].isdigit()}
ROWS_ONLY = {"candidate_metrics", "model_predictions"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_only_model_fitting_lacks_sql():
    own = {name for name in QUERIES if name not in CORPUS}
    assert own - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(SQL) - CORPUS))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck, SQL[name]) == []


def test_model_queries_give_rows(spark):
    """The smallest tables have too few hours with events for a full week of history."""
    folder = SF_DIR.replace("sf0.001", "sf0.01")
    for name in ROWS_ONLY:
        empty = QUERIES[name](spark, "/root/testdata/sf0.001")
        assert empty.isEmpty() and empty.columns == QUERIES[name](spark, folder).columns
    report = QUERIES["candidate_metrics"](spark, folder).collect()
    assert len(report) == 2 and sum(row.is_selected for row in report) == 1
    assert not QUERIES["model_predictions"](spark, folder).isEmpty()


def test_entry_imports_without_the_corpus_folders(tmp_path):
    root = Path(entry_points.__file__).parent
    skip = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(root / "hourgrid", tmp_path / "hourgrid", ignore=skip)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (root / name).exists():
            shutil.copy(root / name, tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True
    )
    own = len(set(QUERIES) - CORPUS)
    assert said.stdout.split() == [str(own), str(own - len(ROWS_ONLY))]


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() == 3
