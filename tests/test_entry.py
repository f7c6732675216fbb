"""The entry module, with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry
from rastercube.plans.queries import ORACLE, QUERIES

REPO = os.path.dirname(os.path.abspath(entry.__file__))


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert {r["channel"] for r in df.collect()} == {"price", "qty", "disc", "tax"} and "mean" in df.columns


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(ORACLE) == set(QUERIES)


def test_the_rest_imports_alone(tmp_path):
    shutil.copytree(os.path.join(REPO, "rastercube"), tmp_path / "rastercube", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(REPO, "__spark_entry__.py"), tmp_path)
    if os.path.exists(pipeline := os.path.join(REPO, "corpus_pipeline.py")):
        shutil.copy(pipeline, tmp_path)  # it may stay when the folder goes
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(ORACLE))], out.stderr


def test_another_missing_module_is_no_silence(tmp_path):
    """Only the absence of the corpus operators is passed over."""
    shutil.copytree(os.path.join(REPO, "rastercube"), tmp_path / "rastercube", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(REPO, "__spark_entry__.py"), tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import a_module_that_is_not_there\n")
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.returncode and "a_module_that_is_not_there" in out.stderr
