"""The rest of the library without its optional parts."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_entry_works_without_the_training_data_operators(tmp_path, pipeline):
    left_out = shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, tmp_path / "repo", ignore=left_out)
    program = "import __spark_entry__ as e; print(sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    done = subprocess.run([sys.executable, "-c", program], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "fact_trips" in done.stdout and "op1_" not in done.stdout and "'pipeline'" not in done.stdout
