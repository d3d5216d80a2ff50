"""Helpers shared by the training-data operators: the shared folder, table
staging, Arrow batches and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the session names none, as in a local test, a temporary folder is
    used and remembered in the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="shoplens-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"


_CACHES: dict[str, Callable[[], None]] = {}


def take_over(name: str, clear: Callable[[], None]) -> None:
    """Called in a task by the operator that is about to use its worker's cache:
    what other operators left in this Python worker, which outlives their
    tasks, is cleared, so a pipeline's caches do not add up."""
    for other in [o for o in _CACHES if o != name]:
        _CACHES.pop(other)()
    _CACHES[name] = clear


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of it with signs added that ``df`` has no column of."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Rows of a staged file, where their number is known before.
FILE_ROWS = 10_000


def stage(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    there, and a lost executor costs no recomputation.

    ``rows``: so many rows at most meet in the last shuffle and leave it.  They
    go to a file per ``FILE_ROWS`` of them, not to one per partition: local file
    systems start processes for each file, and many tiny ones cost more than their rows."""
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(1 + rows // FILE_ROWS)
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _ranges(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > limit:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(sizes):
        yield begin, len(sizes)


def slices(batch: pa.RecordBatch, texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` characters (one row at least), so that
    a task's memory does not follow the size of an Arrow batch."""
    return _ranges(list(map(len, texts)), limit)


def text_slices(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[int, int, list[str]]]:
    """``slices`` of (doc_id, text, ...) rows with their texts (a null text is
    empty); only those of one slice become Python's."""
    column = batch.column(1)
    for begin, end in _ranges(pc.fill_null(pc.utf8_length(column), 0).to_pylist(), limit):
        yield begin, end, [t or "" for t in column.slice(begin, end - begin).to_pylist()]


def over_texts(
    function: Callable[[list, list[str]], dict[str, list]], schema: pa.Schema, limit: int = 4_000_000
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function over (doc_id, text, ...) rows.  ``function``
    takes a slice's ids and texts (a null text is empty) and returns columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for begin, end, texts in text_slices(batch, limit):
                out = function(ids[begin:end], texts)
                yield pa.RecordBatch.from_pydict({f.name: pa.array(out[f.name], f.type) for f in schema}, schema)

    return run


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def _priority(node: Column, turn: int) -> Column:
    return F.xxhash64(node, F.lit(turn))


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """Connected components of an undirected graph with columns (a, b).

    Returns (node, component), component being the smallest node, for every
    node with an edge.  Each turn sends a node to the neighbour (or itself)
    that comes first in a random order of the turn and contracts the edges, so
    the graph shrinks geometrically whatever the ids are.  The driver sees
    only counts; per-node minima are combined before the shuffle, and the
    joins have plain exchanges on both sides, so AQE can split a hub.
    No edges, self-loops and repeated edges are fine.  ``rows``: as in ``stage``."""
    spark = edges.sparkSession
    edges = stage(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a IS NOT NULL AND a < b")
        .distinct(),
        "edges",
        rows,
    )
    label, turn, nodes = None, -1, 0
    while n := edges.count():
        turn += 1
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        near = both.groupBy("a").agg(F.min_by("b", _priority(F.col("b"), turn)).alias("b"))
        first = F.when(_priority(F.col("a"), turn) <= _priority(F.col("b"), turn), F.col("a")).otherwise(F.col("b"))
        near = stage(near.select(F.col("a").alias("node"), first.alias("to")), "near", 2 * n)
        moved = (
            edges.join(near.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
            .join(near.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
            .filter("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
            .distinct()
        )
        edges = stage(moved, "edges", 2 * n)
        if label is None:
            label, nodes = near, 2 * n
        else:
            step = near.select(F.col("node").alias("to"), F.col("to").alias("next"))
            label = stage(
                label.join(step, "to", "left").select("node", F.coalesce("next", "to").alias("to")),
                "label",
                nodes,
            )
    if label is None:
        return empty_like(spark, "node bigint, component bigint")
    least = stage(label.groupBy("to").agg(F.min("node").alias("component")), "least", nodes)
    return label.join(least, "to").select("node", "component")
