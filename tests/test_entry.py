import os
import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["continent", "country", "state", "day_night", "vehicle", "n_frames", "n_videos", "last_frame"] and frame.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_stands_without_llm(tmp_path):
    for name in ("fieldloom", "__spark_entry__.py"):
        (shutil.copytree if (ROOT / name).is_dir() else shutil.copy)(ROOT / name, tmp_path / name)
    shutil.rmtree(tmp_path / "fieldloom" / "llm", ignore_errors=True)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n[:2] == 'op' and n[2].isdigit() or n == 'pipeline'])"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    count, left = said.stdout.split(" ", 1)
    assert int(count) > 40 and left.strip() == "[]"


def test_nothing_else_imports_llm():
    for path in (ROOT / "fieldloom").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "fieldloom.llm" not in path.read_text() and "from .llm" not in path.read_text(), path
