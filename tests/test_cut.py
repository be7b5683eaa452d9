import pytest

from arbor.plans import cut as c


def test_no_local_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        c.shared_dir(Session())


def test_parts(spark):
    df = spark.range(10).selectExpr("id", "id % 3 = 0 as third", "cast(id % 4 as int) as k")
    yes, no, seen = c.split(df, "t", "third")
    assert seen["yes"] == yes.read().count() == 4 and no.read().count() == 6 and (yes + no).read().columns == df.columns
    none, every, seen = c.split(df.where("not third"), "t", "third")
    assert seen["yes"] == none.read().count() == 0 and every.read().count() == 6
    assert [p.read().count() for p in c.split_levels(df, "t", "k")] == [3, 3, 2, 2] and c.split_levels(df.limit(0), "t", "k") == []
    no.drop()
    assert yes.read().count() == 4


def test_tables_go_with_the_application(spark, tmp_path):
    """All that a query writes lies in the application's folder, which goes when the application ends."""
    import os
    import subprocess
    import sys

    code = f"""
import sys
sys.path.insert(0, {os.getcwd()!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
from arbor.plans.cut import cut
assert cut(spark.range(3)).count() == 3
import os
assert len(os.listdir("{tmp_path}/shared/arbor")) == 1
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300)
    assert not any(os.scandir(tmp_path / "shared" / "arbor"))
