from pyspark.sql import functions as F

from arbor import cli
from arbor.sources import sinks


def test_a_large_forest_is_not_one_file(spark, tmp_path, monkeypatch):
    rows = [(i, -1, 100, 1.0) for i in range(1, 65)]
    spark.createDataFrame(rows, "tree_node_index long, desc_node_index long, snapnum int, tree_node_mass double").write.parquet(str(tmp_path / "cat"))
    for name, more in (("many", ""), ("one", "n_files = 1\n")):
        (tmp_path / "a.cfg").write_text(f"[simulation]\nsimulation = LastJourney\n[input]\ntreenodes_base_path = cat\n[output]\noutput_file = {name}\n{more}")
        monkeypatch.setattr(sinks, "ROWS_A_FILE", 10)
        cli.convert(spark, str(tmp_path / "a.cfg"))
    files = {n: spark.read.parquet(str(tmp_path / n)).select(F.input_file_name()).distinct().count() for n in ("many", "one")}
    assert files["one"] == 1 and 1 < files["many"] <= 7
