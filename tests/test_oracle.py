"""Every registered query against its SQL on the smallest tables."""

import subprocess
import sys

import pytest
from oracle import compare

import __spark_entry__ as entry
from tallylake import catalogue

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql()) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("missing", ["xxhash", "tallylake.llm", "corpus_pipeline"])
def test_library_queries_stay_without_the_training_data_operators(missing):
    """In a process of its own, where one module can't be found."""
    code = f"""
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
from tallylake import catalogue
assert set(e.queries()) == set(catalogue.queries()) and set(e.oracle_sql()) == set(catalogue.oracle_sql())
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and "left out" in done.stderr, done.stderr


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["email", "sumamt", "rnk", "datadt"]


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_sql(spark, name):
    frame = catalogue.queries()[name](spark, SF_DIR)
    assert compare(frame, SF_DIR, catalogue.oracle_sql()[name]) == []
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan and "Arrow" not in plan
