"""The entry module imports with and without the optional subpackage."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from ledgersieve.catalog.queries import QUERIES

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("pipeline_stays", [True, False])
@pytest.mark.parametrize("empty_folder_stays", [True, False])
def test_imports_without_the_optional_subpackage(tmp_path, pipeline_stays, empty_folder_stays):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT / "ledgersieve", copy / "ledgersieve", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", copy)
    if pipeline_stays:
        (copy / "corpus_pipeline.py").write_text("from ledgersieve.llm import queries\n")
    if empty_folder_stays:
        (copy / "ledgersieve" / "llm" / "__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
    assert done.stdout.split() == [str(len(QUERIES))] * 2, done.stderr


def test_a_broken_subpackage_is_an_error(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT / "ledgersieve", copy / "ledgersieve", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", copy)
    (copy / "ledgersieve" / "llm").mkdir()
    (copy / "ledgersieve" / "llm" / "queries.py").write_text("import no_such_module\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, capture_output=True, text=True)
    assert "no_such_module" in done.stderr
