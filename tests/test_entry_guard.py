"""The core queries are there whether or not the training-data subpackage can be imported."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()), any(k.startswith('op') for k in E.queries()))"


def outcome(path: str, code: str = COUNT) -> list[str]:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-800:]
    return done.stdout.split()[-3:]


@pytest.fixture()
def copy(tmp_path):
    shutil.copytree(os.path.join(REPO, "lakeward"), tmp_path / "lakeward", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(REPO, "__spark_entry__.py"), tmp_path)
    return tmp_path


def test_without_the_subpackage(copy):
    n, sql, has = outcome(str(copy))
    assert int(n) >= 91 and n == sql and has == "False"


def test_with_an_empty_folder(copy):
    (copy / "lakeward" / "llm").mkdir()
    assert outcome(str(copy))[2] == "False"


def test_with_a_dependency_that_is_missing(copy):
    (copy / "lakeward" / "llm").mkdir()
    (copy / "lakeward" / "llm" / "__init__.py").write_text("")
    (copy / "lakeward" / "llm" / "queries.py").write_text("import a_library_that_is_not_there\n")
    n, sql, has = outcome(str(copy))
    assert int(n) >= 91 and n == sql and has == "False"
