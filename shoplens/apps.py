"""The two applications: the offline report (Q1-Q4) and the real-time ad
pipeline (Q5-Q8), wired from the library's jobs, sources and sinks."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shoplens import params
from shoplens.functions import constants as K
from shoplens.plans import area_product, category, page_jump
from shoplens.session import checkpoint_root
from shoplens.sinks import catalog, fs, jdbc
from shoplens.sources import tables
from shoplens.streaming import ads_app

Writer = Callable[[str, DataFrame], None]


def new_task_id(prefix: str = K.TASK_ID_PREFIX) -> str:
    """One run id per run (K9: the reference read the clock per row)."""
    return f"{prefix}{int(time.time() * 1000)}"


def table_writer(prefix: str = "") -> Writer:
    """Results as catalog tables (replaced each run)."""
    return lambda name, df: catalog.replace_table(df, f"{prefix}{name}")


def jdbc_writer(**options) -> Writer:
    """Results appended to relational tables of the same names."""
    return lambda name, df: jdbc.append(df, table=name, **options)


def run_offline(
    spark: SparkSession,
    sf_dir: str,
    write: Writer,
    cond: params.Conditions = params.DEFAULT,
    task_id: str | None = None,
) -> str:
    """Compute Q1-Q4 and hand each result to ``write(table_name, df)``."""
    task_id = task_id or new_task_id()
    actions_in_range = tables.user_visit_action(spark, sf_dir, cond.start_date, cond.end_date)
    users = tables.user_info(spark, sf_dir)
    q1, q2, release = category.run_category_jobs(actions_in_range, users, cond, task_id=task_id)
    try:
        write("category_top10", q1)
        write("category_session_top10", q2)
    finally:
        release()
    actions = tables.user_visit_action(spark, sf_dir)
    write("jump_page_ratio", page_jump.page_jump_ratio(actions, cond.page_flow, task_id=task_id))
    write(
        "area_count_info",
        area_product.area_product_top3(
            actions, tables.city_info(spark, sf_dir), tables.product_info(spark, sf_dir), task_id=task_id
        ),
    )
    return task_id


def pipeline_checkpoints(spark: SparkSession, root: str) -> str:
    """Checkpoint folder of the pipeline writing to ``root``: under the
    session's ``spark.checkpoint.dir``, one per pipeline, so two pipelines
    never resume each other's state."""
    digest = hashlib.sha1(root.rstrip("/").encode()).hexdigest()[:12]
    return f"{checkpoint_root(spark)}/realtime-{digest}"


def start_realtime_publishers(
    spark: SparkSession,
    root: str,
    window_minutes: int = K.AD_WINDOW_MINUTES,
    top_n: int = K.TOP_ADS,
    trigger: dict | None = None,
    state_watermark: str | None = None,
) -> list[StreamingQuery]:
    """The queries that read the ban filter's output table: running counts
    (Q6), top ads (Q7) and the trailing window (Q8)."""
    filtered_dir = f"{root}/filtered"
    fs.mkdirs(spark, filtered_dir)
    ck = pipeline_checkpoints(spark, root)
    q_counts = ads_app.start_area_counts(
        ads_app.read_filtered(spark, filtered_dir), f"{root}/snapshots",
        checkpoint=f"{ck}/area_counts", trigger=trigger, watermark=state_watermark,
    )
    q_top = ads_app.start_top_ads(
        ads_app.read_filtered(spark, filtered_dir), f"{root}/snapshots", top_n,
        checkpoint=f"{ck}/top_ads", trigger=trigger, watermark=state_watermark,
    )
    q_window = ads_app.start_window_clicks(
        ads_app.read_filtered(spark, filtered_dir), f"{root}/snapshots", window_minutes,
        checkpoint=f"{ck}/window_clicks", trigger=trigger,
    )
    return [q_counts, q_top, q_window]


def start_realtime(
    lines: DataFrame,
    root: str,
    threshold: int = K.BAN_THRESHOLD,
    window_minutes: int = K.AD_WINDOW_MINUTES,
    top_n: int = K.TOP_ADS,
    trigger: dict | None = None,
    state_watermark: str | None = None,
    count_days: int | None = None,
) -> list[StreamingQuery]:
    """Start the ban filter and, after it in the list, the publishers over its
    output table.

    ``root`` is a shared folder: ``filtered/`` holds the kept clicks and ban
    events, ``snapshots/`` the published results; checkpoints go under the
    session's ``spark.checkpoint.dir``."""
    spark = lines.sparkSession
    filtered_dir = f"{root}/filtered"
    fs.mkdirs(spark, filtered_dir)
    q_ban = ads_app.start_ban_filter(
        lines, filtered_dir, threshold, checkpoint=f"{pipeline_checkpoints(spark, root)}/ban_filter",
        trigger=trigger, count_days=count_days,
    )
    return [q_ban] + start_realtime_publishers(spark, root, window_minutes, top_n, trigger, state_watermark)
