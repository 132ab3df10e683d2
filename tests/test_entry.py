"""The driver's contract, with and without the training-data subpackage."""

import re
import shutil
import subprocess
import sys

from conftest import ROOT

import __spark_entry__ as entry


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "spark-warehouse", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql(); import quire.plans.rules"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, env={"PYTHONPATH": str(tmp_path / "repo"), "PATH": "/usr/bin:/bin"} | {k: v for k, v in __import__("os").environ.items() if k.startswith("JAVA")})


def test_nothing_outside_imports_it():
    for path in (ROOT / "quire").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"\bllm\b", path.read_text()), path
