"""Stream ingress.

Every source yields a DataFrame with a text ``value`` column; parsing is
shared with batch (``plans.ads.parse_ads_lines``).  The Kafka connector is not
bundled with plain PySpark: the builders below produce the reader options and
need ``spark-sql-kafka`` on the cluster's classpath.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    bootstrap_servers: str,
    topics: str | list[str],
    group_id: str | None = None,
    starting_offsets: str | Mapping | None = None,
    max_offsets_per_trigger: int | None = None,
    extra: Mapping | None = None,
) -> dict[str, str]:
    """Options for ``readStream.format("kafka")`` (S8 direct, S9 receiver, S10
    0.10 API all map to this one source).  ``starting_offsets`` may be
    ``"earliest"``/``"latest"`` or ``{topic: {partition: offset}}`` (S11)."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "failOnDataLoss": "true",
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    if starting_offsets is not None:
        opts["startingOffsets"] = (
            starting_offsets if isinstance(starting_offsets, str) else offsets_json(starting_offsets)
        )
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def offsets_json(offsets: Mapping) -> str:
    """``{topic: {partition: offset}}`` -> Kafka source offsets JSON."""
    return json.dumps(
        {t: {str(int(p)): int(o) for p, o in parts.items()} for t, parts in offsets.items()},
        sort_keys=True,
    )


def kafka_stream(spark: SparkSession, **kw) -> DataFrame:
    """Kafka records as ``(key, value, topic, partition, offset, timestamp)``
    with key/value as text (P2)."""
    reader = spark.readStream.format("kafka")
    for k, v in kafka_options(**kw).items():
        reader = reader.option(k, v)
    return reader.load().select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def batch_end_offsets(batch: DataFrame) -> DataFrame:
    """Next offset to read per (topic, partition) in one
    micro-batch (``max(offset) + 1``); store it with the batch's results."""
    return batch.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("until_offset"))


def text_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New text files under ``path`` as lines (``value``); files are taken
    oldest first.  The test stand-in for a socket or topic."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    return reader.load(path)


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP socket (development only: not fault tolerant)."""
    return spark.readStream.format("socket").option("host", host).option("port", str(port)).load()


def parquet_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    return reader.parquet(path)
