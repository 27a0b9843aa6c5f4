"""The driver contract with and without the training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

LIST = "import __spark_entry__ as e; print(len(e.queries()), sorted(e.queries()) == sorted(e.oracle_sql()))"


def _listed(folder) -> list[str]:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", LIST], cwd=folder, env=env, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    return run.stdout.split()


def test_reports_stand_without_the_training_data_operators(tmp_path):
    from tally.plans.catalogue import QUERIES
    bare = tmp_path / "bare"
    shutil.copytree(ROOT, bare, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache", "spark-warehouse"))
    assert os.path.exists(bare / "corpus_pipeline.py") and not os.path.exists(bare / "tally" / "llm")
    assert _listed(bare) == [str(len(QUERIES)), "True"]
    os.remove(bare / "corpus_pipeline.py")
    assert _listed(bare) == [str(len(QUERIES)), "True"]
