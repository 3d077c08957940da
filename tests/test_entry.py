import os
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"

# A process that knows the package by sys.path only and stands in another folder, as a driver may.
SCRIPT = f"""
import sys; sys.path.insert(0, {str(REPO)!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
queries = entry.queries()
own = set(entry.catalog.QUERIES)
assert own <= set(entry.oracle_sql()) <= set(queries)
for name in ("token_batches", "response_validation", "normalized_text"):
    assert queries[name](spark, {SF!r}).count() > 0
assert entry.entry(spark).count() > 0
print("fine")
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
def test_queries_run_from_another_folder(tmp_path):
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]
