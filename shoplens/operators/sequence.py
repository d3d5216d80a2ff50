"""Consecutive pairs inside ordered groups.

``lead(value) over (partition by group order by keys)`` is the textbook
form, but it sorts each whole group in one task; a session holding a third of
all rows would become one task.  Here the rows are ranged over partitions by
(group, order) once, so a long group spans several partitions and short ones
share one, and each row meets its neighbour where it lies:

  * inside a partition the next row is the next row: Arrow columns shifted by
    one, batch after batch;
  * only a partition's last row does not know its next row.  The first and last
    row of every partition (two rows, whatever the data) are stitched by one
    small ``lead``.

The partitions' results are checkpointed, because both parts come from them
and must come from one and the same ranging.

``transition_counts`` adds up equal pairs inside the partitions, so what leaves
them is values x values rows; ``transitions`` keeps one row per row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.session import checkpoint_root

#: What a row of a partition's result is: a pair whose next row is known (or
#: known to be none), the partition's first row, or its last row.
_PAIR, _FIRST, _LAST = range(3)


def _same(a: pa.Array, b: pa.Array) -> pa.Array:
    """Element-wise equality, null equal to null."""
    equal = pc.fill_null(pc.equal(a, b), False)
    return pc.or_(equal, pc.and_(pc.is_null(a), pc.is_null(b)))


def _next_rows(batches: Iterator[pa.RecordBatch], out: pa.Schema, counted: bool) -> Iterator[pa.RecordBatch]:
    """(group, frm, nxt, ended, kind, part, n) of a sorted partition's rows
    (group, value).  ``ended``: the row is its group's last.  ``counted``: equal
    (frm, nxt) are added up and the group left out."""
    context = TaskContext.get()
    part = context.partitionId() if context else 0

    def rows(group, frm, nxt, ended, kind, n=None):
        size = len(frm)
        columns = [group, frm, nxt, ended, pa.array([kind] * size), pa.array([part] * size), n if n is not None else pa.array([1] * size)]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    def pairs(group: pa.Array, value: pa.Array):
        """All rows but the last meet their next row."""
        stay = _same(group[:-1], group[1:])
        nxt = value.take(pc.if_else(stay, pa.array(np.arange(1, len(value))), pa.scalar(None, pa.int64())))
        ended = pc.invert(stay)
        if not counted:
            return rows(group[:-1], value[:-1], nxt, ended, _PAIR)
        table = pa.table({"frm": value[:-1], "nxt": nxt, "ended": ended})
        sums = table.group_by(["frm", "nxt", "ended"]).aggregate([([], "count_all")]).combine_chunks()
        frm, nxt, ended, n = (_array(sums[c]) for c in ("frm", "nxt", "ended", "count_all"))
        return rows(pa.nulls(len(n), group.type), frm, nxt, ended, _PAIR, n)

    group = value = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if group is None:
            yield rows(batch.column(0)[:1], batch.column(1)[:1], pa.nulls(1, batch.column(1).type), pa.array([False]), _FIRST)
            group, value = batch.column(0), batch.column(1)
        else:
            group = pa.concat_arrays([group, batch.column(0)])
            value = pa.concat_arrays([value, batch.column(1)])
        if len(group) > 1:
            yield pairs(group, value)
        group, value = group[-1:], value[-1:]
    if group is not None:
        yield rows(group, value, pa.nulls(1, value.type), pa.array([False]), _LAST)


def _array(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _parts(df: DataFrame, group_col: str, order_cols: Sequence[str], value_col: str, counted: bool) -> DataFrame:
    """The partitions' results, written once."""
    checkpoint_root(df.sparkSession)  # the shared folder must be configured
    fields = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType(
        [
            T.StructField("g", fields[group_col]), T.StructField("frm", fields[value_col]), T.StructField("nxt", fields[value_col]),
            T.StructField("ended", T.BooleanType()), T.StructField("kind", T.IntegerType()),
            T.StructField("part", T.IntegerType()), T.StructField("n", T.LongType()),
        ]
    )
    order = [group_col, *order_cols]
    ranged = df.select(*dict.fromkeys([*order, value_col])).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        first, rest = None, iter(batches)
        for first in rest:
            break
        if first is None:
            return
        out = pa.schema(
            [
                ("g", first.column(0).type), ("frm", first.column(1).type), ("nxt", first.column(1).type),
                ("ended", pa.bool_()), ("kind", pa.int32()), ("part", pa.int32()), ("n", pa.int64()),
            ]
        )
        yield from _next_rows(_chain(first, rest), out, counted)

    return ranged.select(F.col(group_col).alias("g"), F.col(value_col).alias("v")).mapInArrow(run, schema).checkpoint()


def _chain(first, rest):
    yield first
    yield from rest


def _stitched(parts: DataFrame) -> DataFrame:
    """The partitions' last rows with the row after each: the next non-empty
    partition's first row, if it is of the same group."""
    ends = parts.filter(F.col("kind") != _PAIR)
    w = Window.partitionBy(F.lit(0)).orderBy("part", "kind")  # two rows a partition
    after = ends.withColumn("a", F.lead(F.struct("g", "frm")).over(w)).filter(F.col("kind") == _LAST)
    same = F.col("a").isNotNull() & F.col("a.g").eqNullSafe(F.col("g"))
    return after.withColumn("nxt", F.when(same, F.col("a.frm"))).withColumn("ended", ~same).drop("a")


def _all_pairs(parts: DataFrame) -> DataFrame:
    return parts.filter(F.col("kind") == _PAIR).unionByName(_stitched(parts))


def transitions(
    df: DataFrame,
    group_col: str,
    order_cols: Sequence[str],
    value_col: str,
    from_col: str = "frm",
    to_col: str = "nxt",
) -> DataFrame:
    """One row per input row: ``(group_col, from_col, to_col)`` where
    ``to_col`` is the value of the next row of the group in the order
    ``order_cols`` (unique within a group), NULL for the last row."""
    rows = _all_pairs(_parts(df, group_col, order_cols, value_col, counted=False))
    return rows.select(F.col("g").alias(group_col), F.col("frm").alias(from_col), F.col("nxt").alias(to_col))


def transition_counts(df: DataFrame, group_col: str, order_cols: Sequence[str], value_col: str) -> DataFrame:
    """(frm, nxt, c): how often value ``nxt`` follows ``frm``; ``nxt`` NULL
    counts rows that are their group's last, or followed by a NULL."""
    rows = _all_pairs(_parts(df, group_col, order_cols, value_col, counted=True))
    return rows.groupBy("frm", "nxt").agg(F.sum("n").alias("c"))


def consecutive_pairs(
    df: DataFrame,
    group_col: str,
    order_cols: Sequence[str],
    value_col: str,
    from_col: str = "frm",
    to_col: str = "nxt",
) -> DataFrame:
    """Only the pairs: ``(group_col, from_col, to_col)`` for adjacent rows."""
    rows = _all_pairs(_parts(df, group_col, order_cols, value_col, counted=False)).filter("NOT ended")
    return rows.select(F.col("g").alias(group_col), F.col("frm").alias(from_col), F.col("nxt").alias(to_col))


def flow_pairs(flow: Sequence) -> list[tuple[str, str]]:
    """Target page flow ``1,2,3`` -> adjacent pairs ``(1,2), (2,3)``.  The
    flow is a job parameter (a handful of pages), not data."""
    items = [str(p).strip() for p in flow]
    return list(zip(items[:-1], items[1:]))
