"""The registered queries without the subpackage of training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

from tidemark.plans import catalog

ROOT = Path(__file__).resolve().parents[1]


def test_entry_imports_without_the_optional_subpackage(tmp_path):
    shutil.copytree(ROOT / "tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    assert said.stdout.split() == [str(len(catalog.QUERIES)), str(len(catalog.ORACLES))]


def test_nothing_else_imports_it():
    for path in (ROOT / "tidemark").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "tidemark.llm" not in path.read_text(), path
