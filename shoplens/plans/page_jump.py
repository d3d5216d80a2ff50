"""Q3: single-step page-jump conversion along a target page flow.

ratio(a-b) = (#times page b directly follows page a inside a session, in
action-time order) / (#visits of page a).  Pairs are formed *before* any
filtering, so an off-flow page in between breaks a jump; the denominator
counts every visit of the from-page, session-last visits included; jumps
never seen are absent (K5).  Equal action times are ordered by ``event_id``
(K4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.operators.sequence import consecutive_pairs, flow_pairs, transition_counts

# Session order: action time, then event id.  The 'yyyy-MM-dd HH:mm:ss' text
# is parsed to an 8-byte timestamp with the same order, so the shuffle that
# orders sessions carries a long instead of a 19-character string.
ORDER = ["__t", "event_id"]


def _timed(actions: DataFrame) -> DataFrame:
    return actions.select("session_id", "event_id", "page_id", F.to_timestamp_ntz("action_time").alias("__t"))


def session_page_pairs(actions: DataFrame) -> DataFrame:
    """(session_id, frm, nxt) for adjacent actions of each session."""
    return consecutive_pairs(_timed(actions), "session_id", ORDER, "page_id")


def page_visit_count(actions: DataFrame, pages: Sequence) -> DataFrame:
    """A4 + P5: visits per page for the given pages (compared as text)."""
    wanted = [str(p) for p in pages]
    return (
        actions.filter(F.col("page_id").cast("string").isin(wanted))
        .groupBy("page_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def page_transition_counts(actions: DataFrame) -> DataFrame:
    """(frm, nxt, c): how often page ``nxt`` directly follows page ``frm``
    in a session; ``nxt`` NULL counts session-last visits.  A pages x pages
    table, whatever the number of actions; the jump numerators and the visit
    denominators both come from it, so the actions are read and shuffled once
    (``operators/sequence.py``) and no session is ever one task's."""
    return transition_counts(_timed(actions), "session_id", ORDER, "page_id")


def _jumps(counts: DataFrame, flow: Sequence) -> DataFrame:
    targets = [f"{a}-{b}" for a, b in flow_pairs(flow)]
    return (
        counts.filter(F.col("nxt").isNotNull())
        .select(F.concat_ws("-", "frm", "nxt").alias("jump"), "frm", "c")
        .filter(F.col("jump").isin(targets))
    )


def page_jump_count(actions: DataFrame, flow: Sequence) -> DataFrame:
    """A5 + P8: (jump, frm, c) for jumps that are steps of the flow."""
    return _jumps(page_transition_counts(actions), flow)


def page_jump_ratio(actions: DataFrame, flow: Sequence, task_id: str | None = None) -> DataFrame:
    """(jump, ratio).  Every jump found has at least one visit of its
    from-page, so the reference's divide-by-1 default (J5) never applies.

    Numerator and denominator come from the one transition-count table:
    ``sum(c) over (partition by frm)`` is the from-page's visit count (each
    group holds at most one row per distinct next page)."""
    counts = page_transition_counts(actions)
    targets = [f"{a}-{b}" for a, b in flow_pairs(flow)]
    from_pages = sorted({a for a, _ in flow_pairs(flow)})
    out = (
        counts.filter(F.col("frm").cast("string").isin(from_pages))
        .withColumn("n", F.sum("c").over(Window.partitionBy("frm")))
        .filter(F.col("nxt").isNotNull())
        .select(
            F.concat_ws("-", "frm", "nxt").alias("jump"),
            (F.col("c").cast("double") / F.col("n")).alias("ratio"),
        )
        .filter(F.col("jump").isin(targets))
    )
    if task_id is not None:
        return out.select(F.lit(task_id).alias("task_id"), "jump", "ratio")
    return out
