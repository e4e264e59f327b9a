"""The entry module works with and without the optional package."""

import os
import shutil
import subprocess
import sys

import __spark_entry__

REPO = os.path.dirname(os.path.abspath(__spark_entry__.__file__))


def test_every_twin_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_imports_without_the_optional_package(tmp_path):
    shutil.copytree(f"{REPO}/gridprep", tmp_path / "gridprep", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 80 and not any(k.startswith('op') or k == 'pipeline' for k in q); print('fine')"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, timeout=120)
    assert "fine" in out.stdout, out.stderr


def test_entry(spark, sf):
    df = __spark_entry__.QUERIES["w05_fill_scale_rollup"](spark, sf)
    assert df.columns == ["grp", "crop", "year", "ha", "is_filled"] and df.count() > 0
