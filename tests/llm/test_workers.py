"""Executors need no copy of the package."""

import os
import subprocess
import sys
from pathlib import Path

from tests.conftest import SF

ROOT = Path(__file__).resolve().parents[2]
RUN = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from shopflow.llm.queries import QUERIES
import corpus_pipeline
from shopflow.session import session
spark = session("local[4]", **{{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}})
for name, query in (QUERIES | {{"pipeline": corpus_pipeline.run}}).items():
    assert query(spark, {SF!r}).collect(), name
print("all", len(QUERIES))
"""


def test_queries_where_workers_cannot_import_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", RUN], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert "all 13" in done.stdout, done.stderr[-3000:]
