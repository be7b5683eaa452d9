"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table `name` of `folder`, a Parquet file or a folder of Parquet files."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def table_stamp(spark: SparkSession, folder: str, name: str) -> tuple[int, int, int]:
    """What changes when the files of a table do: their number, size and time of change."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}.parquet")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held = files.getContentSummary(path)
    return held.getFileCount(), held.getLength(), files.getFileStatus(path).getModificationTime()


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The rows of several files or folders of one kind, with `file`, the place of the path in the list, and `file_name`, that
    of the file itself. Columns that a file lacks are null."""
    if not paths:
        raise ValueError("no path given")
    parts = [spark.read.parquet(p).select("*", F.col("_metadata.file_name").alias("file_name")).withColumn("file", F.lit(i)) for i, p in enumerate(paths)]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out
