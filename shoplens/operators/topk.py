"""Top-k operators.

Per-group top-k is a window rank filtered by ``<= k``; Spark plans it with a
partial ``WindowGroupLimit`` *before* the shuffle, so each map task forwards
at most k rows per group and a hot group never lands whole in one task.
The global top-k is ``orderBy().limit()`` -> ``TakeOrderedAndProject``
(per-partition top-k, then a k-row merge).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_k_per_group(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence,
    k: int,
    with_ties: bool = False,
    rank_col: str | None = None,
) -> DataFrame:
    """Rows ranked ``<= k`` inside each group.

    ``with_ties=False`` -> ``row_number`` (exactly k; give a unique last
    sort key for determinism); ``True`` -> ``rank`` (all ties kept, so a
    group may return more than k rows).
    """
    w = Window.partitionBy(*group_cols).orderBy(*_order(order_cols))
    fn = F.rank() if with_ties else F.row_number()
    name = rank_col or "__rk"
    out = df.withColumn(name, fn.over(w)).filter(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def top_k(df: DataFrame, order_cols: Sequence, k: int) -> DataFrame:
    """Global top-k by the given order (ties broken by the later keys)."""
    return df.orderBy(*_order(order_cols)).limit(k)
