"""Exact top-k inner products, block at a time (operator 2).

Vectors are floored to integers.  They are put in an order that keeps alike
ones together (the signs of their first components) and cut into *chunks* of
consecutive vectors, and chunks into *blocks* of ``BLOCK``.  A block is a
forward index of its vectors, with the largest and smallest weight each term
(component) has in it; the sum of a query's best products with them bounds
every score in the block.

A query takes the blocks of a chunk in the order of their bounds and scores
them in full until the next bound is below its k-th best score.  The k-th best
score in the query's own chunk is known before (it starts every search), so
most of what is far away is never scored.  Query groups meet chunks in a
Cartesian product of partitions: a stated query set against all rows, in
blocks.  A task reads its chunks one after another for its few groups and keeps
the groups' best; no group is copied for each chunk, and none is broadcast,
since the driver would hold them all.  Ties go to the smaller vec_id."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

CHUNK, BLOCK, QUERIES = 8_192, 256, 1_024
#: Chunks and query groups of a task: about so many, but partitions of each: this many at least if there are enough rows.
TASK_CHUNKS, TASK_GROUPS, LEAST_CHUNKS, LEAST_GROUPS = 128, 8, 16, 4
#: Chunks of a range, where ranges are many: the driver draws the bounds from rows of each.
RANGE, RANGES = 8, 256
_NONE = np.iinfo(np.int64).min


def usable(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, e): floor(scale * x) of every component, of the vectors that
    are there and have finite components only."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    floored = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        "vec_id", floored.alias("e")
    )


def _matrix(rows) -> np.ndarray:
    """A row for each vector; missing components weigh nothing."""
    values, offsets = np.asarray(rows.flatten()).astype(np.int64), np.asarray(rows.offsets).astype(np.int64)
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(offsets[:-1], sizes)] = values
    return out


def _narrow(m: np.ndarray) -> np.ndarray:
    """``m`` in the smallest whole numbers that hold it."""
    low, high = int(m.min(initial=0)), int(m.max(initial=0))
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return m.astype(kind)
    return m


def _wide(data: bytes, rows: int, dim: int) -> np.ndarray:
    """The bytes of a narrow matrix as 64-bit numbers."""
    size = len(data) // max(1, rows * dim)
    return np.frombuffer(data, f"i{size or 8}").reshape(rows, dim).astype(np.int64)


_CHUNK = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("dim", pa.int64()), ("ids", pa.binary()), ("data", pa.binary())])


def _chunk_rows(size: int):
    def run(batches):
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        held, n = [], 0

        def flush(rows):
            nonlocal seq
            table = pa.Table.from_batches(rows).combine_chunks()
            e = table["e"].chunk(0) if table["e"].num_chunks else pa.array([], pa.list_(pa.int64()))
            m = _narrow(_matrix(e))
            ids = np.asarray(table["vec_id"]).astype(np.int64)
            seq += 1
            row = {"part": [part], "seq": [seq], "dim": [m.shape[1]], "ids": [ids.tobytes()], "data": [m.tobytes()]}
            return pa.RecordBatch.from_pydict(row, _CHUNK)

        for batch in batches:
            while batch.num_rows:
                take = min(batch.num_rows, size - n)
                held.append(batch.slice(0, take))
                batch, n = batch.slice(take), n + take
                if n == size:
                    yield flush(held)
                    held, n = [], 0
        if held:
            yield flush(held)

    return run


class Chunk:
    """Blocks of a chunk with their bounds."""

    def __init__(self, ids: bytes, data: bytes, dim: int, block: int = BLOCK):
        self.ids = np.frombuffer(ids, np.int64)
        m = _wide(data, len(self.ids), dim)
        self.exact = _float_ok(m)
        self.data = m.astype(np.float64) if self.exact else m.astype(object)
        self.starts = np.arange(0, len(self.ids), block)
        self.high = np.maximum.reduceat(self.data, self.starts, axis=0) if dim else self.data[self.starts]
        self.low = np.minimum.reduceat(self.data, self.starts, axis=0) if dim else self.data[self.starts]
        self.block = block

    def bounds(self, q: np.ndarray) -> np.ndarray:
        zero = q * 0
        return np.maximum(q, zero) @ self.high.T + np.minimum(q, zero) @ self.low.T


def _float_ok(m: np.ndarray) -> bool:
    """Whether float products and sums of such integers are exact."""
    return not m.size or max(int(m.max()), -int(m.min())) ** 2 * m.shape[1] < 1 << 52


def _fit(q: np.ndarray, dim: int) -> np.ndarray:
    """Components that the other side lacks have no product."""
    if q.shape[1] >= dim:
        return q[:, :dim]
    return np.hstack([q, np.zeros((len(q), dim - q.shape[1]), q.dtype)])


def nothing_found(n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    return np.full((n, k), _NONE, np.int64), np.full((n, k), np.iinfo(np.int64).max, np.int64)


def search(
    chunk: Chunk, queries: np.ndarray, k: int, least: np.ndarray, own: np.ndarray, before: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Scores and vec_ids (best first) of the best ``k`` of a chunk and of what
    was found ``before`` (in place), for each query that may reach ``least``;
    ``own``: the query's own place or -1."""
    q = _fit(queries, chunk.data.shape[1])
    exact = chunk.exact and _float_ok(queries) and (
        not q.size or float(np.abs(q).max()) * float(np.abs(chunk.data).max(initial=0)) * q.shape[1] < 1 << 52
    )
    q = q.astype(np.float64 if exact else object)
    data = chunk if exact or not chunk.exact else None
    if data is None:  # a float chunk met a query that needs whole numbers
        data = Chunk(chunk.ids.tobytes(), chunk.data.astype(np.int64).tobytes(), chunk.data.shape[1], chunk.block)
        data.data, data.high, data.low = (x.astype(np.int64).astype(object) for x in (data.data, data.high, data.low))
    bounds = data.bounds(q)
    order = np.argsort(-bounds, axis=1, kind="stable")
    score, ids = before or nothing_found(len(q), k)
    alive = np.arange(len(q))
    for turn in range(order.shape[1]):
        block = order[alive, turn]
        kth = np.maximum(score[alive, -1], least[alive])
        open_ = np.array(bounds[alive, block] >= kth, bool)
        alive, block = alive[open_], block[open_]
        if not len(alive):
            break
        for b in np.unique(block):
            some = alive[block == b]
            begin = int(data.starts[b])
            part = slice(begin, begin + data.block)
            found = q[some] @ data.data[part].T
            if not exact:
                found = np.clip(found.astype(object), _NONE + 1, np.iinfo(np.int64).max)
            found = found.astype(np.int64)
            mine = own[some] - begin
            inside = np.flatnonzero((mine >= 0) & (mine < found.shape[1]))
            found[inside, mine[inside]] = _NONE
            near = (found >= np.maximum(score[some, -1], least[some])[:, None]).any(axis=1)
            some, found = some[near], found[near]
            s = np.hstack([score[some], found])
            v = np.hstack([ids[some], np.broadcast_to(data.ids[part], found.shape)])
            v = np.where(s == _NONE, np.iinfo(np.int64).max, v)
            best = np.lexsort((v, -np.maximum(s, _NONE + 1)), axis=1)[:, :k]
            score[some], ids[some] = np.take_along_axis(s, best, 1), np.take_along_axis(v, best, 1)
    return score, ids


_QUERY = pa.schema(
    [("number", pa.int64()), ("place", pa.int64()), ("piece", pa.int64()), ("query_id", pa.int64()), ("least", pa.int64()),
     ("dim", pa.int64()), ("e", pa.binary())]
)


def _query_rows(every: int, k: int):
    """The chunk's own queries, ``QUERIES`` to a piece, with their k-th best
    score inside it."""

    def run(batches):
        for batch in batches:
            for number, dim, ids, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                chunk = Chunk(ids, data, dim)
                place = np.flatnonzero(chunk.ids % every == 0)
                q = _wide(data, len(chunk.ids), dim)[place]
                score, _ = search(chunk, q, k, np.full(len(place), _NONE, np.int64), place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(place), pa.int64()), pa.array(place, pa.int64()), pa.array(np.arange(len(place)) // QUERIES),
                     pa.array(chunk.ids[place], pa.int64()), pa.array(score[:, -1], pa.int64()),
                     pa.array([dim] * len(place), pa.int64()), pa.array([row.tobytes() for row in _narrow(q)], pa.binary())],
                    schema=_QUERY,
                )

    return run


_FOUND = pa.schema([("home", pa.int64()), ("place", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


class _Group:
    """A group's queries, those of a length together, and their best so far."""

    def __init__(self, queries: list[dict], k: int):
        alike: dict[tuple[int, int], list[dict]] = {}
        for row in queries:
            alike.setdefault((row["dim"], len(row["e"])), []).append(row)
        self.parts = []
        for (dim, _), rows in alike.items():
            q = _wide(b"".join(r["e"] for r in rows), len(rows), dim)
            cols = {n: np.array([r[n] for r in rows], np.int64) for n in ("number", "place", "query_id", "least")}
            self.parts.append((q, cols, nothing_found(len(rows), k)))

    def meet(self, number: int, chunk: Chunk, k: int) -> None:
        for q, cols, best in self.parts:
            search(chunk, q, k, cols["least"], np.where(cols["number"] == number, cols["place"], -1), best)

    def found(self):
        for _, cols, (score, ids) in self.parts:
            at, col = np.nonzero(score != _NONE)
            rows = (*(cols[n][at] for n in ("number", "place", "query_id")), ids[at, col], score[at, col])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows], schema=_FOUND)


def _pair_rows(k: int):
    """The best of a task's chunks for each query of its groups.  The rows are
    pairs, those of a chunk one after another."""

    def run(batches):
        groups: dict[tuple[int, int], _Group] = {}
        at = chunk = None
        for batch in batches:
            for i in range(batch.num_rows):
                number, dim, ids, data, group, piece, queries = (batch.column(c)[i] for c in range(7))
                if at != number.as_py():
                    at, chunk = number.as_py(), Chunk(ids.as_py(), data.as_py(), dim.as_py())
                key = group.as_py(), piece.as_py()
                if key not in groups:
                    groups[key] = _Group(queries.as_py(), k)
                groups[key].meet(at, chunk, k)
        for group in groups.values():
            yield from group.found()

    return run


def _parts(n: int, most: int, least: int) -> int:
    """Partitions of about ``most`` rows of ``n``; ``least`` at least if there are so many rows."""
    return max(1, -(-n // most), min(n, least))


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, chunk: int = CHUNK) -> DataFrame:
    """(query_id, rank, vec_id, score): for every vector whose vec_id is
    divisible by ``every`` the ``k`` best others (all, if fewer).

    Vectors or ids that are null, and vectors with null or non-finite
    components, take no part.  Components that one of two vectors lacks have no
    product, so an empty vector scores 0.  Rows that share a vec_id are vectors
    of their own: each is a query, and they are candidates for each other.
    Scores beyond 64 bits stay at the largest value.  Other columns are
    ignored; an empty table gives an empty result."""
    spark = vectors.sparkSession
    good = usable(vectors)
    code = F.lit(0)
    for i in range(12):
        code = code + F.when(F.get("e", F.lit(i)) >= 0, F.lit(1 << (11 - i))).otherwise(F.lit(0))
    n = vectors.select("vec_id").count()
    ordered = good.withColumn("code", code).repartitionByRange(_parts(-(-n // chunk), RANGE, RANGES), "code", "vec_id")
    ordered = ordered.sortWithinPartitions("code", "vec_id").select("vec_id", "e")
    made = stage(ordered.mapInArrow(_chunk_rows(chunk), "part bigint, seq bigint, dim bigint, ids binary, data binary"), "chunks")
    # A row a chunk: numbered without gaps in one short window.
    number = made.select("part", "seq").withColumn("number", F.row_number().over(Window.orderBy("part", "seq")) - 1)
    numbered = made.join(F.broadcast(number), ["part", "seq"])
    chunks = stage(numbered.select(F.col("number").cast("bigint"), "dim", "ids", "data"), "numbered")
    n_chunks = chunks.count()
    if not n_chunks:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    made_by = "number bigint, place bigint, piece bigint, query_id bigint, least bigint, dim bigint, e binary"
    queries = stage(chunks.mapInArrow(_query_rows(every, k), made_by), "queries")
    n_queries = queries.count()
    together = max(1, QUERIES * n_chunks // max(1, n_queries))  # chunks whose queries form a group
    groups = queries.groupBy(F.floor(F.col("number") / together).alias("group"), "piece").agg(
        F.collect_list(F.struct("number", "place", "query_id", "least", "dim", "e")).alias("queries")
    )
    groups = stage(groups, "groups")
    some_chunks = chunks.coalesce(_parts(n_chunks, TASK_CHUNKS, LEAST_CHUNKS))
    some_groups = groups.repartition(_parts(groups.count(), TASK_GROUPS, LEAST_GROUPS))
    pairs = some_chunks.crossJoin(some_groups.hint("shuffle_replicate_nl"))
    found = pairs.mapInArrow(_pair_rows(k), "home bigint, place bigint, query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("home", "place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
