"""Join helpers with an explicit size check before any broadcast.

Spark already broadcasts a side whose *estimated* size is under
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-plans from runtime
sizes.  ``bounded_broadcast`` decides from the plan's own size: the bytes of the
files, which are compressed, scaled by ``EXPANSION``; otherwise the join is left
to Catalyst (sort-merge, with AQE skew splitting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side of at most this many bytes in memory, as estimated, is shipped to every
# executor.
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
# Bytes in memory for a byte of a compressed file, taken on the large side.
EXPANSION = 4


def is_bounded(df: DataFrame, max_bytes: int) -> bool:
    """True when the optimizer's size of ``df`` (from the files or the table's
    statistics), times ``EXPANSION``, is at most ``max_bytes``.  Looks at the plan
    alone: no job runs, nothing is kept, so a changed input is seen by the next
    call."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes())) * EXPANSION <= max_bytes


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if its estimated size is <= ``max_bytes``; else ``df``
    unchanged, so the join falls back to a shuffle join."""
    return F.broadcast(df) if is_bounded(df, max_bytes) else df


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on,
    how: str = "inner",
    max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Fact x dimension join; the dimension is broadcast only behind the
    size check, otherwise Catalyst/AQE pick the strategy."""
    side = bounded_broadcast(dim, max_broadcast_bytes) if max_broadcast_bytes else dim
    return fact.join(side, on, how)


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` with ``<=>`` (NULL matches NULL), keeping one
    copy of the key columns.

    Used where both sides derive from the same input (a table joined with an
    aggregate of itself): a plain ``=`` join makes Catalyst infer
    ``IS NOT NULL`` on one side and push it under the shared aggregate, so
    the two sides stop sharing one scan and shuffle; ``<=>`` infers nothing
    and also keeps NULL-key groups."""
    keys = list(keys)
    lt, rt = left.alias("__l"), right.alias("__r")
    cond = [F.col(f"__l.{k}").eqNullSafe(F.col(f"__r.{k}")) for k in keys]
    right_rest = [F.col(f"__r.{c}") for c in right.columns if c not in keys]
    return lt.join(rt, cond, how).select(*[F.col(f"__l.{c}") for c in left.columns], *right_rest)
