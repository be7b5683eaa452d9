"""Cutting lineage: a table written once to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or the context's own. Where neither is set, as in tests, a new local one on a
    local master; elsewhere an error, as executors and driver would write to folders that the others can't read."""
    set_to = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not set_to:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        set_to = "file://" + tempfile.mkdtemp(prefix="spark-arbor-")
        spark.sparkContext.setCheckpointDir(set_to)
        set_to = spark.sparkContext.getCheckpointDir()
    return set_to.rstrip("/")


def app_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one; all that is in it goes when the application ends."""
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = f"{shared_dir(spark)}/arbor/{app}"
        path, files = _hadoop(spark, _own[app])
        files.mkdirs(path)
        files.deleteOnExit(path)
    return _own[app]


def _hadoop(spark: SparkSession, folder: str) -> tuple:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _write(df: DataFrame, name: str, by: str | None, counts: dict) -> tuple[str, dict]:
    path = fresh(df.sparkSession, name)
    seen = Observation() if counts else None
    if seen:
        df = df.observe(seen, *(c.alias(k) for k, c in counts.items()))
    (df.write if by is None else df.write.partitionBy(by)).parquet(path)
    return path, {k: v or 0 for k, v in seen.get.items()} if seen else {}


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the application's folder that nothing has been written to."""
    return f"{app_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str = "table", **counts) -> DataFrame | tuple[DataFrame, dict]:
    """`df` written to the shared folder and read again, so that later plans start there and a lost executor costs
    no recomputation. `counts` are aggregate columns gathered during the write; with them the result is a pair."""
    path, seen = _write(df, name, None, counts)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return (back, seen) if counts else back


@dataclass
class Parts:
    """A table in the shared folder in several folders, each of which can be read by itself."""

    spark: SparkSession
    schema: T.StructType
    folders: list[str]

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.folders) if self.folders else self.spark.createDataFrame([], self.schema)

    def __add__(self, other: Parts) -> Parts:
        return Parts(self.spark, self.schema, self.folders + other.folders)

    def drop(self) -> None:
        """Deletes the files; call it only when nothing reads them any more."""
        for folder in self.folders:
            path, files = _hadoop(self.spark, folder)
            files.delete(path, True)


def split(df: DataFrame, name: str, flag: str, **counts) -> tuple[Parts, Parts, dict]:
    """`df` written once, the rows for which the boolean column `flag` holds apart from the others; those come first. The
    counts hold `yes` and `no`, the rows of each, besides the aggregates that are asked for."""
    yes, no = active(F.col(flag)), active(~F.col(flag))
    path, seen = _write(df.withColumn("__part", F.col(flag)), name, "__part", {**counts, "yes": yes, "no": no})
    part = lambda v, n: Parts(df.sparkSession, df.schema, [f"{path}/__part={v}"] if n else [])
    return part("true", seen["yes"]), part("false", seen["no"]), seen


def split_by(df: DataFrame, name: str, column: str, values: range) -> list[Parts]:
    """`df` written once, a folder per value of the whole-number `column`; all of `values` must occur."""
    path, _ = _write(df.withColumn("__part", F.col(column)), name, "__part", {})
    return [Parts(df.sparkSession, df.schema, [f"{path}/__part={v}"]) for v in values]


def split_levels(df: DataFrame, name: str, column: str) -> list[Parts]:
    """The same where `column` holds every whole number from 0 to its greatest, which is found during the write."""
    path, seen = _write(df.withColumn("__part", F.col(column)), name, "__part", {"n": F.max(F.col(column)) + 1})
    return [Parts(df.sparkSession, df.schema, [f"{path}/__part={v}"]) for v in range(seen["n"])]


def stored(df: DataFrame, name: str) -> Parts:
    """`df` written once, as parts."""
    path, _ = _write(df, name, None, {})
    return Parts(df.sparkSession, df.schema, [path])


def drop(df: DataFrame) -> None:
    """Deletes the files behind a table made by `cut`; call it only when nothing reads the table any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path, files = _hadoop(df.sparkSession, folder)
        files.delete(path, True)


def active(flag) -> F.Column:
    """Aggregate: the number of rows for which `flag` holds, for use with `cut`."""
    return F.sum(F.when(flag, F.lit(1)).otherwise(F.lit(0)).cast("long"))
