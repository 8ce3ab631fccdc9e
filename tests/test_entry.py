"""The driver entry with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), len(o), 'pipeline' in q, any(k.startswith('op1_') for k in q), set(o) <= set(q))"


@pytest.mark.parametrize("gone", [["loomtab/llm", "tests/llm"], ["loomtab/llm", "tests/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_the_rest_works_when_corpus_modules_are_deleted(tmp_path, gone):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "__pycache__", *(os.path.basename(g) for g in gone)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path / "copy", env=env, capture_output=True, text=True, check=True).stdout.split()
    assert int(got[0]) > 100 and int(got[1]) > 100
    assert got[2:] == ["False", str("loomtab/llm" not in gone), "True"]
