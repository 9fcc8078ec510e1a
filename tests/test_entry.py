"""The entry point works where the training-data subpackage is absent, pipeline file or not."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_imports_without_the_subpackage(tmp_path, with_pipeline):
    gone = ["llm", "__pycache__", ".git", *([] if with_pipeline else ["corpus_pipeline.py"])]
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(*gone))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') for k in q), 'pipeline' in q, set(e.oracle_sql()) == set(q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[-4]) > 59 and out[-3:] == ["False", "False", "True"]
