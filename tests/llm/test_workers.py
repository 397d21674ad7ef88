"""Executors hold no copy of the package: the queries run where only the driver can import it."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys, tempfile
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", sys.argv[3] + "/cuts").config("spark.sql.warehouse.dir", sys.argv[3] + "/warehouse").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
import corpus_pipeline
from strataforge.llm.queries import QUERIES
try:
    spark.range(1).repartition(1).rdd.map(lambda _: __import__("strataforge")).collect()
except Exception:
    print("absent")
for name, query in [*QUERIES.items(), ("pipeline", corpus_pipeline.run)]:
    print(name, query(spark, sys.argv[2]).count())
"""


def test_without_the_package_on_workers(data, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT, REPO, data, str(tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert run.returncode == 0, run.stderr[-3000:]
    lines = run.stdout.split("\n")
    assert lines[0] == "absent" and len([x for x in lines if x.startswith(("op", "pipeline"))]) == 14
