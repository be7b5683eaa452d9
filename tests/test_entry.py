import os
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"p1_found", "p4_found", "p5_found", "forest_scan", "lc_pipeline"} <= set(entry.queries())


def test_the_rest_stands_without_llm():
    """Nothing outside the subpackage imports it, and the entry drops its queries without it."""
    for path in (ROOT / "arbor").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm" not in path.read_text().replace("``llm``", ""), path
    code = "import sys; sys.modules['arbor.llm'] = None; import __spark_entry__ as e; assert 'p1_found' in e.queries() and 'p2_found' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_workers_get_the_package_wherever_they_run(tmp_path):
    """A driver started in another folder, without the package on its workers' path."""
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
from arbor.plans.ship import ship
ship(spark)
ship(spark)
def where(batches):
    import arbor
    for b in batches:
        yield b.assign(at=arbor.__file__)
assert ".zip" in spark.range(3).mapInPandas(where, "id long, at string").first()["at"]
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=300)
