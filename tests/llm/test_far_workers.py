"""Executors need no copy of the library: only the driver's path has it here."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from tidewell.llm import conversations, hpylm, periodic
docs = spark.createDataFrame([(i, "the in of the in on " * 9) for i in range(8)], "doc_id long, text string")
assert periodic.find_runs(docs).count() == hpylm.score(docs, F.lit(True)).filter("score < 0").count() == 8
rows = spark.createDataFrame([(1, 1, "user", "Hi."), (1, 2, "assistant", "cut")], "conv_id int, turn int, role string, text string")
assert conversations.text_hashes(conversations.repair(rows).turns).count() == 1
print("ok")
"""


def test_workers_have_no_copy(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(SCRIPT.format(repo=str(Path(__file__).resolve().parents[2])))
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_ENV_LOADED") and not k.startswith("PYSPARK_")}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("ok"), done.stderr[-3000:]
