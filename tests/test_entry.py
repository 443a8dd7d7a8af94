"""The driver's contract holds with and without the optional operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import __spark_entry__ as entry
from strandfold.plans import catalog
assert set(entry.queries()) == set(entry.oracle_sql()) == set(catalog.queries())
"""


def run_without(folder, *left_out):
    """Import the entry in a copy of the library that lacks some of its parts."""
    shutil.copytree(ROOT, folder / "copy", ignore=lambda at, names: [
        n for n in names if n.startswith(".") or n == "__pycache__" or str(Path(at, n).relative_to(ROOT)) in left_out])
    return subprocess.run([sys.executable, "-B", "-c", CODE], cwd=folder / "copy", timeout=120, capture_output=True, text=True)


@pytest.mark.parametrize("left_out", [("corpus_pipeline.py", "strandfold/llm"), ("strandfold/llm",), ("corpus_pipeline.py",), ("strandfold/llm/__init__.py", "strandfold/llm/queries.py")])
def test_entry_without_the_corpus_operators(tmp_path, left_out):
    assert run_without(tmp_path, *left_out).returncode == 0


def test_errors_in_the_corpus_operators_are_told(tmp_path):
    if not (ROOT / "strandfold/llm").exists():
        pytest.skip("left out")
    found = run_without(tmp_path, "strandfold/llm/common.py")
    assert found.returncode and "strandfold.llm.common" in found.stderr


def test_sql_belongs_to_queries():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
