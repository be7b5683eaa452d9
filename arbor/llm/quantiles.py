"""Percentiles from mergeable summaries with a tracked bound on the rank error."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values of a buffer. Of n values, ranks err by at most n * log2(n / K) / (2 * K), and not at all up to K values.
K = 2048
#: Values that a task holds before it hands its summaries on.
HELD = 2_000_000
#: First-stage merges of one key.
FAN = 64
SUMMARY = "level int, err double, vals array<double>"


class Summary:
    """Buffers of K sorted values, at most one of each weight 2^level, and fewer than K loose values of weight 1.

    Two buffers of equal weight collapse into one of twice the weight, which holds every second value of their merge,
    beginning with the first and with the second in turn. A collapse of weight w moves any rank by at most w; `err`
    sums these. So the schedule of collapses is a binary tree, and the weights add up to the number of values.
    """

    def __init__(self, k: int = K):
        self.k, self.loose, self.n_loose, self.full, self.err, self.turn = k, [], 0, {}, 0.0, {}

    def add(self, values: np.ndarray) -> None:
        self.loose.append(values)
        self.n_loose += len(values)
        if self.n_loose >= self.k:
            every = np.concatenate(self.loose)
            whole = len(every) // self.k * self.k
            for i in range(0, whole, self.k):
                self.put(0, np.sort(every[i : i + self.k]))
            self.loose, self.n_loose = [every[whole:]], len(every) - whole

    def put(self, level: int, values: np.ndarray) -> None:
        while level in self.full:
            both = np.sort(np.concatenate([self.full.pop(level), values]), kind="mergesort")
            first = self.turn[level] = 1 - self.turn.get(level, 1)
            values = both[first::2]
            self.err += 2.0**level
            level += 1
        self.full[level] = values

    def rows(self) -> Iterator[tuple[int, float, np.ndarray]]:
        """(level, err, values); loose values have level -1, and err is with the first row."""
        parts = [(-1, np.concatenate(self.loose))] if self.n_loose else []
        for i, (level, values) in enumerate([*parts, *sorted(self.full.items(), key=lambda x: x[0])]):
            yield level, self.err if i == 0 else 0.0, values


def summarize(df: DataFrame, keys: list[str], value: str, k: int = K) -> DataFrame:
    """keys, part, level, err, vals: summaries of the finite values per combination of `keys` (whole numbers or null),
    made by each task of the rows it reads; `merged` combines them. Null, NaN and infinite values don't count; repeated
    rows do. Keys are read as whole numbers."""
    schema = df.select(*(F.col(c).cast("long").alias(c) for c in keys), F.col(value).cast("double").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Summary] = {}
        n, part = 0, 0

        def out() -> Iterator[pa.RecordBatch]:
            rows = [(key, *r) for key, s in held.items() for r in s.rows()]
            for i in range(0, len(rows), 500):
                some = rows[i : i + 500]
                cols = [pa.array([r[0][j] for r in some], pa.int64()) for j in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([r[1] for r in some], pa.int32()), pa.array([r[2] for r in some], pa.float64()), pa.array([r[3] for r in some], pa.list_(pa.float64()))], names=[*keys, "level", "err", "vals"])

        for batch in batches:
            v = batch.column(len(keys)).to_numpy(zero_copy_only=False).astype(float)
            fine = np.isfinite(v)
            if not fine.any():
                continue
            frame = pd.DataFrame({j: batch.column(j).to_pandas(integer_object_nulls=True) for j in range(len(keys))})[fine].reset_index(drop=True)
            v = v[fine]
            for key, at in frame.groupby(list(range(len(keys))), dropna=False, sort=False).indices.items():
                key = key if isinstance(key, tuple) else (key,)
                key = tuple(None if pd.isna(x) else int(x) for x in key)
                held.setdefault(key, Summary(k)).add(v[at])
            n += len(v)
            if n >= HELD:
                yield from out()
                held, n = {}, 0
        yield from out()

    made = schema.mapInArrow(run, ", ".join(f"{c} long" for c in keys) + ", " + SUMMARY)
    return made.withColumn("part", F.spark_partition_id())


def _by_key(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, Iterator[tuple[int, float, np.ndarray]]]]:
    """Of rows (`width` key columns, level, err, vals) sorted by key, each key with its (level, err, values)."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            lists = batch.column(width + 2)
            flat, at = lists.flatten().to_numpy(), np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
            keys = zip(*(batch.column(j).to_pylist() for j in range(width)))
            for i, (key, level, err) in enumerate(zip(keys, batch.column(width).to_pylist(), batch.column(width + 1).to_pylist())):
                yield key, level, err, flat[at[i] : at[i + 1]]

    for key, same in groupby(rows(), key=lambda r: r[0]):
        yield key, (r[1:] for r in same)


def merged(summaries: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    """Summaries combined per combination of `keys`, a subset of those they were made for: days or files may be merged
    in any grouping. Merging goes in two stages of FAN parts each, so no task gets the summaries of all tasks for one
    key at once. Summaries of a key come in a row, sorted, and a task holds one key's at a time."""
    schema = ", ".join(f"{c} long" for c in keys) + ", part int, " + SUMMARY
    width = len(keys) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []

        def out() -> pa.RecordBatch:
            cols = [pa.array([r[0][j] for r in rows], pa.int64() if j < width - 1 else pa.int32()) for j in range(width)]
            return pa.RecordBatch.from_arrays([*cols, pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.float64()), pa.array([r[3] for r in rows], pa.list_(pa.float64()))], names=[*keys, "part", "level", "err", "vals"])

        for key, parts in _by_key(batches, width):
            held = Summary(k)
            for level, err, values in parts:
                held.err += err
                held.add(values) if level < 0 else held.put(level, values)
            rows += [(key, *r) for r in held.rows()]
            if len(rows) > 500:
                yield out()
                rows = []
        if rows:
            yield out()

    def stage(df: DataFrame) -> DataFrame:
        return df.repartition(*keys, "part").sortWithinPartitions(*keys, "part", "level", "src").drop("src").mapInArrow(run, schema)

    first = stage(summaries.select(*keys, (F.col("part") % FAN).alias("part"), "level", "err", "vals", F.col("part").alias("src")))
    return stage(first.select(*keys, F.lit(0).alias("part"), "level", "err", "vals", F.col("part").alias("src")))


def percentiles(summaries: DataFrame, keys: list[str], percents: list[int]) -> DataFrame:
    """keys, percent, value, n_values, max_rank_error: for each key and percent p the value of rank ceil(p * n / 100)
    (at least 1) of the summary; its true rank differs by at most max_rank_error. `summaries` are of one row set per
    key, as `merged` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, parts in _by_key(batches, len(keys)):
            levels, errs, lists = zip(*parts)
            values = np.concatenate(lists)
            weights = np.concatenate([np.full(len(v), 2 ** max(0, level), dtype=np.int64) for level, v in zip(levels, lists)])
            order = np.argsort(values, kind="stable")
            up = np.cumsum(weights[order])
            n, m = int(up[-1]), len(percents)
            at = [int(np.searchsorted(up, max(1, -(-p * n // 100)))) for p in percents]
            cols = [pa.array([x] * m, pa.int64()) for x in key]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(percents, pa.int32()), pa.array(values[order][at]), pa.array([n] * m, pa.int64()), pa.array([float(sum(errs))] * m)], names=[*keys, "percent", "value", "n_values", "max_rank_error"])

    rows = summaries.select(*keys, "level", "err", "vals").repartition(*keys).sortWithinPartitions(*keys)
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in keys) + ", percent int, value double, n_values long, max_rank_error double")
