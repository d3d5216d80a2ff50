"""The ad-click streaming application (Q5-Q8): Structured Streaming queries
around one filtered table (T8 fan-out):

  1. ``start_ban_filter``  lines -> parse -> ``foreachBatch`` ban filter
     (``streaming/ban_filter.py``).  The table holds kept clicks and bans.
  2. ``start_area_counts`` kept clicks -> running count per (date, area, city,
     ad) (T2), update mode -> the changed keys go into a keyed table.  With
     ``watermark=`` the state of old days is evicted (T13).
  3. ``start_top_ads``     kept clicks -> running count per (date, area, ad),
     update mode -> top ads of the (date, area) groups whose top changed (T9).
  4. ``start_window_clicks`` kept clicks -> counts per (ad, minute of arrival,
     minute of the click) with a watermark on arrival -> the trailing window.

Published tables have versions of their own (``sinks/commits.py``): a replayed
batch adds nothing and a reset checkpoint does not bring old rows back.
Checkpoints live under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shoplens.functions import columns as C
from shoplens.functions import constants as K
from shoplens.operators.joins import null_safe_join
from shoplens.operators.topk import top_k_per_group
from shoplens.plans import ads as A
from shoplens.session import checkpoint_root
from shoplens.sinks.commits import writer_of
from shoplens.sinks.snapshot import KeyedTable, SnapshotTable
from shoplens.streaming import ban_filter as BF
from shoplens.streaming.sources import parquet_stream

FILTERED_SCHEMA = BF.OUTPUT_SCHEMA


def _trigger(writer, trigger: dict | None):
    """E.g. ``{"processingTime": "3 seconds"}`` (the reference's batch
    interval) in production, ``{"availableNow": True}`` in tests."""
    return writer.trigger(**(trigger or {"processingTime": "3 seconds"}))


def _ck(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or f"{checkpoint_root(spark)}/{name}"


# --- 1. ban filter ---------------------------------------------------------------

def stamped(lines: DataFrame) -> DataFrame:
    """Lines with the ``arrival`` (epoch ms) they came with, else the time a
    Kafka record was taken in, else the time of the micro-batch."""
    if "arrival" in lines.columns:
        return lines.withColumn("arrival", F.col("arrival").cast("bigint"))
    if {"topic", "offset", "timestamp"} <= set(lines.columns):
        return lines.withColumn("arrival", F.unix_millis("timestamp"))
    return lines.withColumn("arrival", F.unix_millis(F.current_timestamp()))


def start_ban_filter(
    lines: DataFrame,
    filtered_dir: str,
    threshold: int = K.BAN_THRESHOLD,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    name: str = "ads_ban_filter",
    count_days: int | None = None,
) -> StreamingQuery:
    spark = lines.sparkSession
    state = BF.BanFilter(spark, filtered_dir, threshold, count_days=count_days)
    state.settle(state.log.latest())
    writer = (
        A.parse_ads_lines(stamped(lines))
        .writeStream.foreachBatch(state.process)
        .option("checkpointLocation", _ck(spark, name, checkpoint))
        .queryName(name)
    )
    return _trigger(writer, trigger).start()


def read_filtered(spark: SparkSession, filtered_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    # the folders' ``epoch`` is part of the schema from the start, when there may be none yet
    schema = T.StructType([*FILTERED_SCHEMA.fields, T.StructField("epoch", T.LongType())])
    return parquet_stream(spark, filtered_dir, schema, max_files_per_trigger).drop("epoch")


# --- 2. running counts ------------------------------------------------------------

COUNTS_SCHEMA = "date STRING, area STRING, city STRING, adid STRING, cnt BIGINT"
TOP_SCHEMA = "date STRING, area STRING, top ARRAY<STRUCT<rn: INT, adid: STRING, cnt: BIGINT>>"


def area_counts_table(spark: SparkSession, snapshot_root: str) -> KeyedTable:
    return KeyedTable(spark, f"{snapshot_root}/date_area_city_ad", COUNTS_SCHEMA, ["date", "area", "city", "adid"])


def top_ads_table(spark: SparkSession, snapshot_root: str) -> KeyedTable:
    return KeyedTable(spark, f"{snapshot_root}/top3_ads_per_day", TOP_SCHEMA, ["date", "area"])


def _counted(kept: DataFrame, keys: list[str], watermark: str | None) -> DataFrame:
    if not watermark:
        return kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
    day = F.date_trunc("day", F.timestamp_millis("timestamp"))
    return (
        kept.withColumn("day", day).withWatermark("day", watermark).groupBy("day", *keys).agg(F.count(F.lit(1)).alias("cnt"))
    )


def start_area_counts(
    filtered: DataFrame,
    snapshot_root: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    name: str = "ads_area_counts",
    watermark: str | None = None,
) -> StreamingQuery:
    """Q6: running counts in update mode; a micro-batch writes the keys it
    changed and nothing else.

    Default: state is never evicted (as the reference; late clicks count
    under their own date).  ``watermark`` (e.g. ``"2 days"``) adds an
    event-time watermark on the click's day, so the state of days older than
    the watermark is dropped (clicks arriving later than that for such a day
    are then ignored: a documented difference); published counts stay."""
    spark = filtered.sparkSession
    table = area_counts_table(spark, snapshot_root)

    def publish(changed: DataFrame, batch_id: int) -> None:
        table.upsert(changed, batch_id, writer_of(changed))

    counts = _counted(BF.kept_clicks(filtered), ["date", "area", "city", "adid"], watermark)
    writer = (
        counts.writeStream.outputMode("update")
        .foreachBatch(publish)
        .option("checkpointLocation", _ck(spark, name, checkpoint))
        .queryName(name)
    )
    return _trigger(writer, trigger).start()


# --- 3. top ads -----------------------------------------------------------------------

def next_top(top: DataFrame, changed: DataFrame, top_n: int) -> DataFrame:
    """(date, area, top) of the groups whose top changes, from the top before
    and the new totals (date, area, adid, cnt) of the ads that were clicked.

    Totals only grow, so an ad that was not clicked and was not in the top
    cannot enter it: the rest of a group need not be looked at."""
    group = ["date", "area"]
    touched = changed.select(*group).distinct()
    before = null_safe_join(touched, top, group)
    stay = before.select(*group, F.explode("top").alias("t")).select(*group, "t.adid", "t.cnt")
    new_keys = changed.select(*[F.col(c).alias(f"_{c}") for c in (*group, "adid")])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*group, "adid")]
    pool = stay.join(new_keys, same, "left_anti").unionByName(changed.select(*group, "adid", "cnt"))
    best = top_k_per_group(pool, group, [F.col("cnt").desc(), F.col("adid").asc()], top_n, rank_col="rn")
    after = best.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct(F.col("rn").cast("int").alias("rn"), "adid", "cnt"))).alias("top")
    )
    old = before.select(*group, F.col("top").alias("_top"))
    return null_safe_join(after, old, group, "left").filter(~F.col("top").eqNullSafe(F.col("_top"))).drop("_top")


def start_top_ads(
    filtered: DataFrame,
    snapshot_root: str,
    top_n: int = K.TOP_ADS,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    name: str = "ads_top_ads",
    watermark: str | None = None,
) -> StreamingQuery:
    """Q7: top ads per (date, area) of running counts; a micro-batch ranks the
    groups it clicked in and writes those whose top changed.  After a reset of
    the checkpoint totals grow again from nothing; the top then shows the
    larger totals of before until each ad's clicks have been read again.
    ``watermark`` as for ``start_area_counts``."""
    spark = filtered.sparkSession
    table = top_ads_table(spark, snapshot_root)

    def publish(changed: DataFrame, batch_id: int) -> None:
        changed = changed.select("date", "area", "adid", F.col("cnt").cast("bigint").alias("cnt")).persist()
        try:
            table.upsert(next_top(table.read(), changed, top_n), batch_id, writer_of(changed))
        finally:
            changed.unpersist()

    counts = _counted(BF.kept_clicks(filtered), ["date", "area", "adid"], watermark)
    writer = (
        counts.writeStream.outputMode("update")
        .foreachBatch(publish)
        .option("checkpointLocation", _ck(spark, name, checkpoint))
        .queryName(name)
    )
    return _trigger(writer, trigger).start()


def read_area_counts(spark: SparkSession, snapshot_root: str) -> tuple[DataFrame, DataFrame]:
    """Published Q6 key/value rows and Q7 top ads, all dates."""
    top = top_ads_table(spark, snapshot_root).read()
    return (
        A.date_area_city_ad_kv(area_counts_table(spark, snapshot_root).read()),
        A.top_ads_kv(top.select("date", "area", C.pairs_json("top", "adid", "cnt").alias("top3"))),
    )


# --- 4. trailing window of per-minute counts -------------------------------------------

WINDOW_ROWS_SCHEMA = "adid STRING, arrival_ms BIGINT, minute_ms BIGINT, cnt BIGINT"


def minute_counts(kept: DataFrame, window_minutes: int, ahead_seconds: int = K.AHEAD_SECONDS) -> DataFrame:
    """(adid, arrived, minute, cnt): clicks per minute of arrival and minute of
    their own clock, with a watermark on arrival one window long, so the state
    of minutes that left the window is dropped.  A click whose clock is more
    than ``ahead_seconds`` ahead of its arrival is counted under no minute.

    Arrival is the pipeline's own clock: no click can move it."""
    ahead = F.col("timestamp") > F.col("arrival") + int(ahead_seconds) * 1000
    minute = F.when(~ahead, F.date_trunc("minute", F.timestamp_millis("timestamp")))
    return (
        kept.withColumn("arrived", F.date_trunc("minute", F.timestamp_millis("arrival")))
        .withColumn("minute", minute)
        .withWatermark("arrived", f"{int(window_minutes)} minutes")
        .groupBy("adid", "arrived", "minute")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def window_view(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Window rows (adid, arrival_ms, minute_ms, cnt) -> Q8 (adid, hhmm, cnt)
    and the per-ad JSON form."""
    t = C.ntz_from_millis("minute_ms")
    labelled = rows.filter("minute_ms IS NOT NULL").select("adid", "minute_ms", C.minute_label(t).alias("hhmm"), "cnt")
    per_label = labelled.groupBy("adid", "hhmm").agg(
        F.sum("cnt").alias("cnt"), F.min("minute_ms").alias("first_minute")
    )
    ordered = F.array_sort(F.collect_list(F.struct("first_minute", "hhmm", "cnt")))
    per_ad = per_label.groupBy("adid").agg(C.pairs_json(ordered, "hhmm", "cnt").alias("minutes"))
    return per_label.select("adid", "hhmm", "cnt"), per_ad


def window_table(spark: SparkSession, snapshot_root: str) -> SnapshotTable:
    return SnapshotTable(spark, f"{snapshot_root}/last_hour_ads_click")


def publish_window(table: SnapshotTable, window_minutes: int):
    """Merge a micro-batch's changed minutes into the window and replace it."""

    def publish(changed: DataFrame, batch_id: int) -> None:
        writer = writer_of(changed)
        changed = changed.select(
            "adid",
            F.unix_millis("arrived").alias("arrival_ms"),
            F.unix_millis("minute").alias("minute_ms"),
            F.col("cnt").cast("bigint").alias("cnt"),
        ).persist()
        try:
            keys = ["adid", "arrival_ms", "minute_ms"]
            new_keys = changed.select(*[F.col(c).alias(f"_{c}") for c in keys])
            stay = table.read("rows", WINDOW_ROWS_SCHEMA).join(
                new_keys, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys], "left_anti"
            )
            merged = stay.unionByName(changed)
            end = merged.select(F.max("arrival_ms")).scalar()
            current = merged.filter(F.col("arrival_ms") > end - int(window_minutes) * 60_000).persist()
            try:
                _, per_ad = window_view(current)
                table.publish({"rows": current, "kv": A.last_window_kv(per_ad)}, batch_id, writer)
            finally:
                current.unpersist()
        finally:
            changed.unpersist()

    return publish


def start_window_clicks(
    filtered: DataFrame,
    snapshot_root: str,
    window_minutes: int = K.AD_WINDOW_MINUTES,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    name: str = "ads_window_clicks",
    ahead_seconds: int = K.AHEAD_SECONDS,
) -> StreamingQuery:
    spark = filtered.sparkSession
    counts = minute_counts(BF.kept_clicks(filtered), window_minutes, ahead_seconds)
    writer = (
        counts.writeStream.outputMode("update")
        .foreachBatch(publish_window(window_table(spark, snapshot_root), window_minutes))
        .option("checkpointLocation", _ck(spark, name, checkpoint))
        .queryName(name)
    )
    return _trigger(writer, trigger).start()


def read_window(spark: SparkSession, snapshot_root: str) -> tuple[DataFrame, DataFrame]:
    """Latest Q8 version as (adid, hhmm, cnt) and per-ad JSON."""
    return window_view(window_table(spark, snapshot_root).read("rows", WINDOW_ROWS_SCHEMA))


def read_ahead(spark: SparkSession, snapshot_root: str) -> DataFrame:
    """(adid, cnt): the window's clicks whose clock is ahead of their arrival."""
    rows = window_table(spark, snapshot_root).read("rows", WINDOW_ROWS_SCHEMA)
    return rows.filter("minute_ms IS NULL").groupBy("adid").agg(F.sum("cnt").alias("cnt"))
