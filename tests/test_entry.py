"""The driver contract with and without the optional parts."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
LIST = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def listed(folder: Path) -> tuple[set[str], set[str]]:
    said = subprocess.run([sys.executable, "-B", "-c", LIST], cwd=folder, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    names, sql = said.stdout.splitlines()[-2:]
    return set(names.split()), set(sql.split())


@pytest.fixture
def copy(tmp_path):
    ignored = shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache", "*.json", "*.md", "*.txt")
    return Path(shutil.copytree(ROOT, tmp_path / "copy", ignore=ignored))


@pytest.mark.parametrize("pipeline", [True, False])
@pytest.mark.parametrize("empty_folder", [True, False])
def test_entry_without_the_subpackage(copy, pipeline, empty_folder):
    """Neither the pipeline's file nor an empty folder left behind brings the deleted queries back."""
    if not pipeline:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    if empty_folder:
        (copy / "kpiloom" / "llm" / "__pycache__").mkdir(parents=True)
    names, sql = listed(copy)
    assert "activation_daily" in names and "activation_daily" in sql
    assert not [n for n in names | sql if n.startswith("op") or n == "pipeline"]


def test_sql_has_queries():
    names, sql = listed(ROOT)
    assert sql <= names
