"""The library without the training-data modules: a copy of the repository that lacks both llm folders."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
import __spark_entry__ as entry
from periodlens.plans import catalog
assert set(entry.queries()) == set(catalog.all_queries())
assert set(entry.oracle_sql()) == set(catalog.all_oracle_sql())
print("fine", len(entry.queries()))
"""


def test_queries_and_tests_without_the_llm_folders(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", "*.json"))
    env = {**os.environ, "PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
    for present in (True, False):  # with and without the pipeline's file
        if not present:
            (copy / "corpus_pipeline.py").unlink()
        out = subprocess.run([sys.executable, "-c", CODE], cwd=copy, env=env, capture_output=True, text=True)
        assert out.returncode == 0, out.stderr
        assert out.stdout.startswith("fine")
    collected = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only", "--rootdir", str(copy)], cwd=copy, env=env, capture_output=True, text=True)
    assert collected.returncode == 0, collected.stdout[-2000:]
