"""The driver contract holds with and without the corpus subpackage."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry
from cabgrid.plans import ALL_ORACLE_SQL, ALL_QUERIES
from conftest import ROOT

LISTS = "import __spark_entry__ as e; print(*sorted(e.queries()), '/', *sorted(e.oracle_sql()))"


def test_every_trip_query_is_registered():
    assert set(ALL_QUERIES) <= set(entry.queries()) and set(ALL_ORACLE_SQL) <= set(entry.oracle_sql())


def test_a_copy_without_the_corpus_folders_keeps_the_other_queries(tmp_path):
    """With the pipeline's file (it imports the folder that is gone) and without."""
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(ROOT, "cabgrid"), copy / "cabgrid", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), copy)
    env = {**os.environ, "PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
    for _ in range(2):
        out = subprocess.run([sys.executable, "-c", LISTS], cwd=copy, env=env, capture_output=True, text=True, check=True).stdout
        assert out.split() == [*sorted(ALL_QUERIES), "/", *sorted(ALL_ORACLE_SQL)]
        if (copy / "corpus_pipeline.py").exists():
            (copy / "corpus_pipeline.py").unlink()
