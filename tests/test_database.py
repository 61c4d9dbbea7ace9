"""The embedded database: odd texts, and executors in JVMs of their own."""

import os
import subprocess
import sys
from pathlib import Path

import pyspark

from pairloom.plans import files

ON_EXECUTORS = """
import sys
from pyspark.sql import SparkSession
from pairloom.plans import files
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.executor.memory", "512m").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://" + sys.argv[2]).getOrCreate()
print("rows", files.database_scan(spark, sys.argv[1]).count())
"""


def test_odd_texts_come_back(spark, tmp_path, rows):
    texts = ['a"b', '""', "a,b", "two\nlines", "\r\n", " both ends ", "", None, "\\\\", "'", "größe 桌子 \U0001f600", "x" * 50_000]
    made = [(t, c, n) for t in texts for c, n in ((t, 9), (None, 4), ("x", 3), ("y", None))]
    spark.createDataFrame(made, "uid string, category string, used_count int").write.parquet(str(tmp_path / "assets.parquet"))
    assert rows(files.database_scan(spark, str(tmp_path))) == sorted([m for m in made if m[2] and m[2] > 3], key=repr)


def test_no_rows(spark, tmp_path):
    spark.createDataFrame([], "uid string, category string, used_count int").write.parquet(str(tmp_path / "assets.parquet"))
    assert files.database_scan(spark, str(tmp_path)).count() == 0


def test_executors_of_their_own(spark, sf, tmp_path):
    home = tmp_path / "home"
    (home / "work").mkdir(parents=True)  # where executors log
    for p in Path(pyspark.__file__).parent.iterdir():
        if p.name != "work":
            (home / p.name).symlink_to(p)
    root = str(Path(__file__).resolve().parent.parent)
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_"))} | {"SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", ON_EXECUTORS, sf, str(tmp_path / "shared")], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert f"rows {spark.read.parquet(f'{sf}/assets.parquet').where('used_count > 3').count()}" in done.stdout, done.stderr[-2000:]
