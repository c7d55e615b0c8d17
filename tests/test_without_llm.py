"""The library works where the optional training-data operators are missing, in part or whole."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


@pytest.mark.parametrize("missing", [["replyloom/llm"], ["corpus_pipeline.py"], ["replyloom/llm", "corpus_pipeline.py"]])
def test_entry_imports_without(tmp_path, missing):
    skip = shutil.ignore_patterns(".git", "__pycache__", "*.json", "spark-warehouse")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=lambda d, names: {*skip(d, names), *(n for n in names if os.path.relpath(os.path.join(d, n), ROOT) in missing)})
    found = subprocess.run([sys.executable, "-c", LIST], cwd=tmp_path / "repo", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert found.returncode == 0, found.stderr
    queries, sql, pipeline = found.stdout.split()
    assert int(queries) == int(sql) > 90 and pipeline == "False"
