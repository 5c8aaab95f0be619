import subprocess
import sys

import __spark_entry__ as e


def test_names_and_oracles():
    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.oracle_sql()) > 100


def test_entry(spark):
    rows = e.entry(spark).collect()
    assert len(rows) == 7 and all(len(r.checksum) == 64 for r in rows)


def test_the_rest_stands_without_the_subpackage():
    code = "import sys; sys.modules['lakeshift.llm'] = None; import __spark_entry__ as e; assert len(e.queries()) > 100 and not any(n.startswith('op1') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True)


def test_executors_get_the_package(tmp_path):
    """From a folder where workers can't find it."""
    import os

    root = os.path.dirname(os.path.abspath(e.__file__))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as e
assert e.queries()["cdc_text_decode"](s, "/root/testdata/sf0.001").count() == 1000
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env=env)
