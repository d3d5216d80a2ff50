"""Q9: running word count over a text stream, recoverable from its
checkpoint (T3, T10, F14).

The count per word is Spark's streaming aggregation state (partial counts per
task before the shuffle, so a very frequent word costs one row per task).
Each micro-batch publishes only the words whose count changed (update mode)
into a keyed table (``sinks/snapshot.py``): the per-batch cost is the words
that batch touched, and the files a reader opens do not grow with the batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shoplens.plans.ads import running_word_count
from shoplens.session import checkpoint_root
from shoplens.sinks.commits import writer_of
from shoplens.sinks.snapshot import KeyedTable

COUNTS_SCHEMA = "word STRING, n BIGINT"


def word_counts_table(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(spark, root, COUNTS_SCHEMA, ["word"])


def start_word_count(
    lines: DataFrame,
    root: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    name: str = "running_word_count",
) -> StreamingQuery:
    spark = lines.sparkSession
    table = word_counts_table(spark, root)

    def publish(changed: DataFrame, batch_id: int) -> None:
        table.upsert(changed, batch_id, writer_of(changed))

    writer = (
        running_word_count(lines)
        .writeStream.outputMode("update")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint or f"{checkpoint_root(spark)}/{name}")
        .queryName(name)
        .trigger(**(trigger or {"processingTime": "3 seconds"}))
    )
    return writer.start()


def read_word_counts(spark: SparkSession, root: str) -> DataFrame:
    """Current count of every word, as of the last committed batch."""
    return word_counts_table(spark, root).read()
