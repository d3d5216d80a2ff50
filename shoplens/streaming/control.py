"""Stream lifecycle helpers: graceful stop on a marker file (T11) and resume
from a checkpoint (T10: restarting a query with the same checkpoint location
continues after the last committed batch, state included)."""

from __future__ import annotations

import signal
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from shoplens.sinks import fs


def stop_gracefully(query: StreamingQuery, poll_seconds: float = 0.2, max_wait: float | None = None) -> None:
    """Let the in-flight micro-batch finish, then stop between batches.  With
    ``max_wait`` seconds given, a longer batch is interrupted."""
    deadline = None if max_wait is None else time.time() + max_wait
    while query.isActive and query.status.get("isTriggerActive") and (deadline is None or time.time() < deadline):
        time.sleep(poll_seconds)
    query.stop()


def run_until_marker(
    spark: SparkSession,
    query: StreamingQuery,
    marker_path: str,
    poll_seconds: float = 5.0,
    timeout: float | None = None,
) -> str:
    """Poll every ``poll_seconds``; when ``marker_path`` exists (on the
    cluster's filesystem) stop the query gracefully.  Returns why it ended:
    ``"marker"``, ``"terminated"`` or ``"timeout"``; a failed query raises."""
    start = time.time()
    while True:
        if query.awaitTermination(poll_seconds):
            return "terminated"
        if fs.exists(spark, marker_path):
            stop_gracefully(query)
            return "marker"
        if timeout is not None and time.time() - start > timeout:
            return "timeout"


def stop_in_order(stages) -> None:
    """Stop the queries of an app whose stages feed one another: each stage is
    stopped between batches, and the stage after it works off all that was
    committed by then before it is stopped itself, so nothing that one query
    has let through is left behind in the next."""
    failed = None
    for number, stage in enumerate(stages):
        for q in stage:
            try:
                if number and failed is None and q.isActive:
                    q.processAllAvailable()  # the stage before has ended: nothing more comes
            except Exception as error:  # the others are stopped before it is raised
                failed = error
            if q.isActive:
                stop_gracefully(q)
    if failed is not None:
        raise failed


def run_all(
    spark: SparkSession, queries, marker_path: str | None = None, poll_seconds: float = 5.0, downstream=()
) -> str:
    """Wait until ``marker_path`` appears or every query has ended; returns
    ``"marker"`` or ``"terminated"``.  At the marker ``queries`` stop first, and
    the queries of ``downstream``, which read their output, when they have
    worked it off.  A query that fails stops the others and raises, so no app
    goes on half dead."""
    stages = [list(queries), list(downstream)]
    every = [q for stage in stages for q in stage]
    while True:
        failed = next((q for q in every if not q.isActive and q.exception() is not None), None)
        if failed is not None:
            for q in every:
                if q.isActive:
                    stop_gracefully(q)
            raise failed.exception()
        if marker_path is not None and fs.exists(spark, marker_path):
            stop_in_order(stages)
            return "marker"
        active = [q for q in every if q.isActive]
        if not active:
            return "terminated"
        try:
            active[0].awaitTermination(poll_seconds)
        except Exception:  # raised above, after the others are stopped
            continue


def stop_on_signal(queries, signals=(signal.SIGTERM, signal.SIGINT), downstream=()):
    """Stop the given queries gracefully, and then the ``downstream`` ones (see
    ``run_all``), when the driver gets one of ``signals``.
    Returns the handler, which can also be called directly.  Install from
    the driver's main thread."""

    def handler(signum=None, frame=None):
        stop_in_order([list(queries), list(downstream)])

    for s in signals:
        signal.signal(s, handler)
    return handler
