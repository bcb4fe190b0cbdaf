"""The driver contract without the optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

from shoplens.plans import registry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_queries_without_optional_parts(tmp_path, left_out):
    copy = tmp_path / "copy"
    skipped = shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse", *left_out)
    shutil.copytree(ROOT, copy, ignore=skipped)
    code = "import __spark_entry__ as E; print(*E.queries()); print(*E.oracle_sql())"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True,
                          env={**os.environ, "PYTHONPATH": str(copy)})
    assert done.returncode == 0, done.stderr
    queries, oracles = (set(line.split()) for line in done.stdout.splitlines())
    assert set(registry.queries()) <= queries and set(registry.oracle_sql()) <= oracles
    assert "pipeline" not in queries and ("llm" not in left_out or queries == set(registry.queries()))
