"""The library stands without the training-data operators."""

import os
import shutil
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_llm_folders(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(HERE, copy, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "*.pyc"))
    code = ("import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q);"
            "assert not any(n.startswith('op') or n == 'pipeline' for n in q); print(len(q))")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env=env)
    assert done.returncode == 0 and int(done.stdout) > 80, done.stderr
