"""Topic sink (S19): rows as text lines on a Kafka topic (needs the Kafka
connector on the cluster classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def topic_options(bootstrap_servers: str, topic: str, extra: dict | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def as_records(df: DataFrame, value_col: str = "value", key_col: str | None = None) -> DataFrame:
    cols = [F.col(value_col).cast("string").alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*cols)


def write_lines(df: DataFrame, bootstrap_servers: str, topic: str, value_col: str = "value", key_col=None) -> None:
    as_records(df, value_col, key_col).write.format("kafka").options(
        **topic_options(bootstrap_servers, topic)
    ).save()
