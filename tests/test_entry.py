"""The driver contract of __spark_entry__."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as E

REPO = os.path.dirname(os.path.abspath(E.__file__))


def test_entry_runs_with_a_stable_schema(spark):
    df = E.entry(spark)
    assert df.schema.simpleString() == "struct<city:string,sales:double>"
    assert len(df.collect()) > 0


def test_every_query_of_the_reference_has_an_oracle():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    own = {k for k in q if not k.startswith("op") and k != "pipeline"}
    assert own == set(E.catalog.queries()) and own <= set(sql) and len(own) >= 39
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and "select" in s.lower() for s in sql.values())


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py")])
def test_the_library_imports_without_the_training_data_operators(tmp_path, left_out):
    copy = tmp_path / "copy"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", *left_out))
    code = ("import __spark_entry__ as E; q = E.queries(); assert set(E.oracle_sql()) == set(q) == set(E.catalog.queries()); "
            "import rollwise.reports, bench; print(E.__file__)")
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, timeout=120)
    assert done.returncode == 0, done.stderr
    assert str(copy) in done.stdout
    found = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=copy,
                           capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stdout + found.stderr
