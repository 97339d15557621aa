"""The library without its training-data subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

LOOK = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.registered.queries()), len(e.oracle_sql()))"


@pytest.mark.parametrize("kept", [(), ("corpus_pipeline.py",), ("corpus_pipeline.py", "paperloom/llm/__pycache__")])
def test_entry_imports_without_llm(tmp_path, kept):
    shutil.copytree(f"{ROOT}/paperloom", tmp_path / "paperloom", ignore=lambda d, names: ["llm"] if d == f"{ROOT}/paperloom" else [])
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    for name in kept:
        if name.endswith(".py"):
            (tmp_path / name).write_text("from paperloom.llm import mixing\n")
        else:
            (tmp_path / name).mkdir(parents=True)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", LOOK], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert out.stdout.split()[:1] == ["True"] and int(out.stdout.split()[1]) > 80, out.stderr
