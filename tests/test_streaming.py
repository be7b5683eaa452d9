import datetime as dt

from arbor.streaming.arrivals import arrivals


def test_stream_equals_batch(spark, tmp_path):
    t = lambda d, h=0: dt.datetime(2031, 3, d, h)
    schema = "tree_node_index long, snapnum short, tree_node_mass float, loaded_at timestamp"
    first = [(1, 100, 2.0, t(1)), (1, 100, 2.0, t(1, 5)), (2, 100, float("nan"), t(1)), (3, 99, None, t(2))]
    second = [(4, 99, 8.0, t(2, 3)), (5, 98, 1.0, t(20)), (6, 98, None, None)]
    for i, rows in enumerate((first, second)):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{i}"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = arrivals(stream).writeStream.outputMode("complete").format("memory").queryName("arrivals_test").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    key = lambda r: (r.window.start, r.snapnum, r.n_rows, r.n_keys, r.bad_mass, r.mass_sum)
    got = sorted(map(key, spark.table("arrivals_test").collect()))
    assert got == sorted(map(key, arrivals(spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))).collect()))
    assert got[0][1:] == (100, 3, 2, 1, 4.0)
