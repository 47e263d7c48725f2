"""The entry point without the training-data folders: the other queries are there."""

import os
import shutil
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert "silver_lines" in q and "silver_lines" in o and set(o) <= set(q)
assert not [k for k in q if k.startswith("op") or k == "pipeline"], sorted(q)
"""


def _run_copy(workdir, *left_out):
    copy = os.path.join(workdir, "copy")
    ignore = shutil.ignore_patterns("__pycache__", ".git", *left_out)
    shutil.copytree(HERE, copy, ignore=ignore)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_entry_without_the_llm_folder(workdir):
    _run_copy(workdir, "llm")


def test_entry_without_the_llm_folder_and_the_pipeline(workdir):
    _run_copy(workdir, "llm", "corpus_pipeline.py")


def test_entry_with_an_emptied_llm_folder(workdir):
    copy = os.path.join(workdir, "copy")
    shutil.copytree(HERE, copy, ignore=shutil.ignore_patterns("__pycache__", ".git", "llm"))
    os.makedirs(os.path.join(copy, "strata", "llm"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
