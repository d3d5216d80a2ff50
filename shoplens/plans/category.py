"""Q1 and Q2: top categories by (pay, order, click) counts among the filtered
actions, and the most clicking sessions inside each top category.

The reference counts with a driver-merged accumulator map; here it is one
grouped aggregate (partial counts per map task, so a hot category costs one
row per task in the shuffle), followed by a global top-k."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import constants as K
from shoplens.operators.filters import action_categories, action_kind, filter_actions, is_click
from shoplens.operators.topk import top_k, top_k_per_group
from shoplens.params import Conditions

__all__ = [
    "filter_actions",
    "category_counts",
    "category_top10",
    "category_session_kind_counts",
    "top_categories_from",
    "category_session_counts",
    "category_session_top10",
    "run_category_jobs",
]


def category_counts(actions: DataFrame) -> DataFrame:
    """A1: per category id (string) the click, order and pay counts.

    Each action counts under one kind only (click > order > pay, K1); id
    lists are split Java-style and empty ids dropped (K6)."""
    touched = actions.select(
        action_kind().alias("kind"), F.explode(action_categories()).alias("category_id")
    )
    return touched.groupBy("category_id").agg(
        F.count_if(F.col("kind") == "click").alias("click_count"),
        F.count_if(F.col("kind") == "order").alias("order_count"),
        F.count_if(F.col("kind") == "pay").alias("pay_count"),
    )


def category_top10(actions: DataFrame, n: int = K.TOP_CATEGORIES, task_id: str | None = None) -> DataFrame:
    """O1: pay desc, order desc, click desc; category id ascending breaks the
    remaining ties (K3)."""
    top = top_k(category_counts(actions), _top_order(), n)
    cols = ["category_id", "click_count", "order_count", "pay_count"]
    if task_id is not None:
        return top.select(F.lit(task_id).alias("task_id"), *cols)
    return top.select(*cols)


def category_session_kind_counts(actions: DataFrame) -> DataFrame:
    """Per (category, session) the click, order and pay counts, from one scan.

    Both Q1 (summed over sessions) and Q2 (clicks of the top categories)
    can be answered from this, so the actions are read and joined once."""
    touched = actions.select(
        "session_id", action_kind().alias("kind"), F.explode(action_categories()).alias("category_id")
    )
    return touched.groupBy("category_id", "session_id").agg(
        F.count_if(F.col("kind") == "click").alias("click_count"),
        F.count_if(F.col("kind") == "order").alias("order_count"),
        F.count_if(F.col("kind") == "pay").alias("pay_count"),
    )


def _top_order():
    return [
        F.col("pay_count").desc(),
        F.col("order_count").desc(),
        F.col("click_count").desc(),
        F.col("category_id").asc(),
    ]


def top_categories_from(session_counts: DataFrame, n: int = K.TOP_CATEGORIES) -> DataFrame:
    per_category = session_counts.groupBy("category_id").agg(
        F.sum("click_count").alias("click_count"),
        F.sum("order_count").alias("order_count"),
        F.sum("pay_count").alias("pay_count"),
    )
    return top_k(per_category, _top_order(), n).select(
        "category_id", "click_count", "order_count", "pay_count"
    )


def category_session_counts(
    actions: DataFrame, top_categories: DataFrame | None = None, n_categories: int = K.TOP_CATEGORIES
) -> DataFrame:
    """A3 + J4: clicks per (category, session) for the top categories.

    ``top_categories`` defaults to ``category_top10(actions)``.  It is a
    ``limit(n)`` result: its plan statistics carry the n-row bound, so
    Spark's size check broadcasts it for the semi-join."""
    if top_categories is None:
        top_categories = category_top10(actions, n_categories)
    clicks = actions.filter(is_click()).select(
        F.col("click_category_id").cast("string").alias("category_id"), "session_id"
    )
    clicks = clicks.join(top_categories.select("category_id"), "category_id", "left_semi")
    return clicks.groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count"))


def category_session_top10(
    actions: DataFrame,
    top_categories: DataFrame | None = None,
    n: int = K.TOP_SESSIONS,
    task_id: str | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The n sessions with most clicks per top category (session id
    ascending breaks ties).  A top category without clicks has no rows (K2)."""
    order = [F.col("click_count").desc(), F.col("session_id").asc()]
    if counts is None and top_categories is None:
        # One scan: the categories' ranking and the sessions' come from the same
        # (category, session) counts.  Both branches need all three counts (the
        # last two as order columns behind the unique session id, so they decide
        # nothing) and the join is null-safe, so both read one shuffle.
        kinds = category_session_kind_counts(actions)
        best = top_categories_from(kinds).select(F.col("category_id").alias("best"))
        counts = kinds.filter("click_count > 0").join(best, F.col("category_id").eqNullSafe(F.col("best")), "left_semi")
        order += [F.col("order_count").desc(), F.col("pay_count").desc()]
    elif counts is None:
        counts = category_session_counts(actions, top_categories)
    else:
        counts = counts.join(top_categories.select("category_id"), "category_id", "left_semi")
    top = top_k_per_group(counts, ["category_id"], order, n)
    cols = ["category_id", "session_id", "click_count"]
    if task_id is not None:
        return top.select(F.lit(task_id).alias("task_id"), *cols)
    return top.select(*cols)


def run_category_jobs(actions: DataFrame, users: DataFrame, cond: Conditions, task_id: str | None = None):
    """Q1 + Q2 with one scan and join of the filtered actions.

    Both results derive from the per-(category, session) counts, which are
    persisted (memory, spilling to disk; recomputed from lineage if an
    executor is lost) so the two results do not each re-read the actions.
    Returns ``(q1, q2, release)``; call ``release()`` after writing both."""
    counts = category_session_kind_counts(filter_actions(actions, users, cond)).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    top = top_categories_from(counts)
    clicks = counts.filter(F.col("click_count") > 0).select("category_id", "session_id", "click_count")
    q2 = category_session_top10(None, top, task_id=task_id, counts=clicks)
    q1 = top if task_id is None else top.select(F.lit(task_id).alias("task_id"), *top.columns)
    return q1, q2, counts.unpersist
