"""Offsets kept with the results.

For a Kafka-fed job that manages its own offsets: each micro-batch publishes
its results and the next offset per (topic, partition) in one commit
(``sinks/commits.py``), so the two can never disagree.  After a failure, or
with a new checkpoint, the job starts at ``starting_offsets``; records below the
offsets published, which a source that starts earlier brings again, are left
out of the batch.  Versions are the log's own and rise on, whatever the batch
ids of the new checkpoint are.  With Spark's own checkpoint alone none of this
is needed; it serves sinks and readers that track offsets themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.sinks.commits import CommitLog, writer_of
from shoplens.sinks.snapshot import SnapshotTable
from shoplens.streaming.sources import batch_end_offsets, offsets_json

OFFSETS_SCHEMA = "topic STRING, partition INT, until_offset BIGINT"

Combine = Callable[[DataFrame | None, DataFrame], DataFrame]


def _published(table: SnapshotTable) -> dict[str, dict[str, int]]:
    return table.note().get("offsets", {})


def _not_yet(batch: DataFrame, offsets: dict) -> DataFrame:
    """The batch's records at or past the offsets (one row per topic partition)."""
    rows = [(t, int(p), o) for t, parts in offsets.items() for p, o in parts.items()]
    if not rows:
        return batch
    known = batch.sparkSession.createDataFrame(rows, OFFSETS_SCHEMA).select(
        F.col("topic").alias("_topic"), F.col("partition").alias("_partition"), "until_offset"
    )
    here = (F.col("topic") == F.col("_topic")) & (F.col("partition") == F.col("_partition"))
    return batch.join(known, here & (F.col("offset") < F.col("until_offset")), "left_anti")


def publish_with_offsets(root: str, compute: Callable[[DataFrame], DataFrame], combine: Combine | None = None):
    """``foreachBatch`` function: the results of ``compute(batch)`` replace those
    before, or ``combine(results before, results)`` does where given (None
    before the first), and the batch's end offsets go with them.  A batch
    without new records publishes nothing."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        table = SnapshotTable(batch.sparkSession, root)
        writer = writer_of(batch)
        if CommitLog.replayed(table.log.latest(), writer, batch_id):
            return
        offsets = _published(table)
        fresh = _not_yet(batch, offsets).persist()
        try:
            # one row per topic partition
            ends = batch_end_offsets(fresh).collect()
            if not ends:
                return
            merged = {t: dict(parts) for t, parts in offsets.items()}
            for r in ends:
                merged.setdefault(r.topic, {})[str(int(r.partition))] = int(r.until_offset)
            results = compute(fresh)
            if combine is not None:
                results = combine(table.read(), results)
            table.publish(results, batch_id, writer, note={"offsets": merged})
        finally:
            fresh.unpersist()

    return publish


def results(spark: SparkSession, root: str, schema=None) -> DataFrame | None:
    """The results published last."""
    return SnapshotTable(spark, root).read(schema=schema)


def starting_offsets(spark: SparkSession, root: str, default: str = "earliest") -> str:
    """``startingOffsets`` option for a restart: the offsets stored with the
    last published results, or ``default`` when nothing was published."""
    offsets = _published(SnapshotTable(spark, root))
    return offsets_json(offsets) if offsets else default
