"""Every operator on workers that cannot import the library."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = '''
import os, sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "3").getOrCreate()
def present(_):
    import importlib.util
    return [importlib.util.find_spec("tripkpi") is not None]
assert spark.sparkContext.parallelize([0], 1).mapPartitions(present).collect() == [False]
sys.path.insert(0, {root!r})
from tripkpi.llm.queries import QUERIES
import corpus_pipeline
for name, f in [*QUERIES.items(), ("pipeline", corpus_pipeline.run)]:
    print(name, f(spark, {sf!r}).count(), flush=True)
'''


def test_all_queries(sf_small, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, sf=sf_small)], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=1500)
    assert out.returncode == 0, out.stderr[-3000:]
    assert len(out.stdout.split()) == 2 * 14
