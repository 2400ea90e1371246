import os
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry
from gristmill import queries

REPO = Path(__file__).resolve().parents[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(queries.QUERIES) <= set(entry.queries())


def test_without_the_llm_folders(tmp_path):
    for p in REPO.iterdir():
        if p.name not in ("corpus_pipeline.py", "gristmill", ".git"):
            (tmp_path / p.name).symlink_to(p)
    (tmp_path / "gristmill").mkdir()
    for p in (REPO / "gristmill").iterdir():
        if p.name != "llm":
            (tmp_path / "gristmill" / p.name).symlink_to(p)
    code = "import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n.startswith('op') or n == 'pipeline'])"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert said.stdout.strip() == f"{len(queries.QUERIES)} []"


def test_what_the_llm_folders_import_must_be_there(tmp_path):
    """Only the folders themselves may be missing, not a package that they need."""
    (tmp_path / "ahocorasick.py").write_text("raise ModuleNotFoundError('gone', name='ahocorasick')")
    said = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__"], cwd=REPO, env=os.environ | {"PYTHONPATH": f"{tmp_path}:{REPO}"}, capture_output=True, text=True)
    assert not (REPO / "gristmill/llm").is_dir() or "gone" in said.stderr
