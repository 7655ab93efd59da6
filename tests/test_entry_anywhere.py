"""The entry module works when loaded by path from another directory (workers find the package)."""
import os
import subprocess
import sys
import tempfile

SCRIPT = """
import importlib.util
spec = importlib.util.spec_from_file_location("entry_mod", {path!r})
m = importlib.util.module_from_spec(spec)
spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.showConsoleProgress", "false").getOrCreate()
print("nodes", m.queries()["isolation_forest_fit"](spark, "/root/testdata/sf0.001").count())
print("entry", m.entry(spark).count() > 0)
"""


def test_entry_loaded_by_path_from_elsewhere():
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = SCRIPT.format(path=os.path.join(here, "__spark_entry__.py"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tempfile.gettempdir(), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "nodes 200" in out.stdout, out.stderr[-2000:]
    assert "entry True" in out.stdout
