"""Log-structured storage of keyed rows: every batch adds a small segment, and
segments of like size are merged when there are enough of them, so what a
batch writes follows the rows it brings and not the rows there are, and the
number of segments grows with the logarithm of the store.

Rows of one key may lie in several segments; ``merge`` combines them (the
newest wins, sums, minima), and must give the same result in any grouping."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shoplens.sinks import fs
from shoplens.sinks.commits import CommitLog

#: Segments of one size class before they are merged, and the smallest class.
FANOUT, LEAST_BYTES = 8, 1 << 16
EPOCH = "_epoch"

Merge = Callable[[DataFrame], DataFrame]


def newest(keys: Sequence[str]) -> Merge:
    """Of each key's rows the one of the latest epoch."""

    def merge(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys and c != EPOCH]
        best = rows.groupBy(*keys).agg(F.max_by(F.struct(EPOCH, *rest), EPOCH).alias("_best"))
        return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest], F.col(f"_best.{EPOCH}").alias(EPOCH))

    return merge


def summed(keys: Sequence[str], value: str) -> Merge:
    """Each key's values added up."""
    return lambda rows: rows.groupBy(*keys).agg(F.sum(value).alias(value))


def least(keys: Sequence[str], value: str) -> Merge:
    return lambda rows: rows.groupBy(*keys).agg(F.min(value).alias(value))


def read(spark: SparkSession, segments: list[dict], schema) -> DataFrame:
    """Rows of all segments, a key's rows not yet combined."""
    if not segments:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[s["path"] for s in segments])


def write(log: CommitLog, rows: DataFrame, sort: Sequence[str] = (), watch: Sequence[Column] = ()) -> dict:
    """A new segment; ``sort`` orders its files' rows for readers that prune.
    ``watch``: aggregates taken while writing, without a job of their own, and
    given back by name under ``seen``."""
    path = log.new_path()
    rows = rows.sortWithinPartitions(*sort) if sort else rows
    seen = Observation()
    (rows.observe(seen, *watch) if watch else rows).write.parquet(path)
    out = {"path": path, "bytes": fs.size(rows.sparkSession, path)}
    return out | {"seen": seen.get} if watch else out


def size_class(n_bytes: int, fanout: int = FANOUT) -> int:
    return max(0, math.floor(math.log(max(n_bytes, 1) / LEAST_BYTES, fanout)) + 1) if n_bytes > LEAST_BYTES else 0


def compact(
    log: CommitLog, segments: list[dict], schema, merge: Merge, sort: Sequence[str] = (), fanout: int = FANOUT
) -> list[dict]:
    """Merge the segments of each size class that holds ``fanout`` of them."""
    while True:
        classes: dict[int, list[dict]] = {}
        for s in segments:
            classes.setdefault(size_class(s["bytes"], fanout), []).append(s)
        full = [c for c in sorted(classes) if len(classes[c]) >= fanout]
        if not full:
            return segments
        old = classes[full[0]]
        merged = write(log, merge(read(log.spark, old, schema)), sort)
        segments = [s for s in segments if s not in old] + [merged]
