"""The driver contract without the optional package."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LOAD = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"


@pytest.mark.parametrize("gone", [(), ("corpus_pipeline.py",)], ids=["pipeline left", "pipeline gone"])
def test_import_without_the_optional_package(folder, gone):
    skip = {"llm", ".git", "__pycache__", *gone}
    shutil.copytree(ROOT, f"{folder}/copy", ignore=lambda at, names: skip & set(names))
    told = subprocess.run([sys.executable, "-c", LOAD], cwd=f"{folder}/copy", capture_output=True, text=True, check=True)
    assert told.stdout.split() == ["84", "81"]
