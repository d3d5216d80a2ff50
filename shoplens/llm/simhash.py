"""Near-duplicate documents by SimHash (operator 11).

A fingerprint has a bit set where over half of the hashes of a text's word
shingles (repeats included) have it.  Documents whose fingerprints differ in at
most ``radius`` bits link; links become connected components.

*Tiled exact comparison.*  Equal fingerprints are one class, counted before the
shuffle.  Two fingerprints within r bits have population counts within r, and
so do the counts of their four 16-bit words taken together: the sum of the
four differences is at most r.  Fingerprints of one count vector make a cell,
cut into tiles of about ``TILE``; only tiles of cells whose vectors are within
the radius meet, each pair of tiles once, and a tile is shipped as one array.
Where two tiles meet, both are ordered by the counts of their eight bytes and
cut again; pairs of these smaller tiles are skipped by the least and largest
byte counts, the others compared whole with exclusive-or and bit counts.  No
candidate is guessed and none is dropped.

Two tiles report no more links than join their members into the same
components (a spanning forest), so a family of near copies costs links in
proportion to its members.  Texts are never shuffled.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, over_texts, stage

SEED = 42
WORDS = 4  # 16-bit words of a fingerprint whose counts name its cell
#: Fingerprints of a tile, about, and of the smaller tiles compared whole.
TILE, INNER = 32_768, 256
#: A cell's name holds each word's count plus ``_ROOM`` in ``_DIGIT`` bits, so
#: that a neighbour's never borrows; radii go up to ``_ROOM``.
_DIGIT, _ROOM = 6, 8
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str, width: int = 3) -> int:
    """The text's fingerprint as an unsigned number; no words: zero."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), min(width, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist(), strict=True)]
    counts = np.zeros((8, 256), np.int64)
    at = np.arange(8) * 256
    for first in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[first : first + (1 << 16)], "<u8")
        counts += np.bincount((part.view(np.uint8).reshape(-1, 8) + at).ravel(), minlength=2048).reshape(8, 256)
    over = (counts @ _BITS) * 2 > len(hashes)
    return int.from_bytes(np.packbits(over, axis=1, bitorder="little").tobytes(), "little")


def _fingerprint_rows(width: int):
    def rows(ids: list, texts: list[str]) -> dict[str, list]:
        signed = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
        return {"doc_id": ids, "fp": signed}

    return rows


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp) of every row, fp being the 64 bits as a signed number.  A
    null or wordless text has the fingerprint zero."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
    return docs.select("doc_id", "text").mapInArrow(over_texts(_fingerprint_rows(width), schema), "doc_id bigint, fp bigint")


def _cell(fp: str):
    name = F.lit(0).cast("bigint")
    for k in range(WORDS):
        word = F.shiftrightunsigned(F.col(fp), 16 * k).bitwiseAND(F.lit(0xFFFF))
        name = name + F.shiftleft((F.bit_count(word) + _ROOM).cast("bigint"), _DIGIT * k)
    return name


def cell_steps(radius: int) -> list[int]:
    """What to add to a cell's name to get those of the cells within the
    radius; of each pair of opposite steps the positive one."""
    steps = range(-radius, radius + 1)
    near = (d for d in product(steps, repeat=WORDS) if sum(map(abs, d)) <= radius)
    return sorted(s for s in (sum(x << (_DIGIT * k) for k, x in enumerate(d)) for d in near) if s >= 0)


class _Parts:
    """Labels of the components found so far among a pair of tiles."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.label[i], self.label[j]
            open_ = a != b
            if not open_.any():
                return
            i, j, low, high = i[open_], j[open_], np.minimum(a, b)[open_], np.maximum(a, b)[open_]
            np.minimum.at(self.label, high, low)  # hang the larger roots below
            while True:  # to the roots
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def _inner(values: np.ndarray) -> tuple[np.ndarray, list[slice], np.ndarray, np.ndarray]:
    """(order, small tiles, least and largest byte counts of each)."""
    counts = np.bitwise_count(values.view(np.uint8).reshape(-1, 8)).astype(np.int16)
    order = np.lexsort(counts.T)
    counts = counts[order]
    cuts = np.arange(0, len(values), INNER)
    tiles = [slice(c, min(c + INNER, len(values))) for c in cuts.tolist()]
    return order, tiles, np.minimum.reduceat(counts, cuts), np.maximum.reduceat(counts, cuts)


def near_in_tiles(x: np.ndarray, y: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the members of two tiles (of one, if ``y`` is None) into
    the components that all pairs within the radius would make."""
    both = x if y is None else np.concatenate([x, y])
    parts = _Parts(len(both))
    xo, xt, x_least, x_most = _inner(x)
    yo, yt, y_least, y_most = (xo, xt, x_least, x_most) if y is None else _inner(y)
    xs, ys = x[xo], (x if y is None else y)[yo]
    shift = 0 if y is None else len(x)
    for k, a in enumerate(xt):
        gap = np.maximum(0, np.maximum(x_least[k] - y_most, y_least - x_most[k])).sum(axis=1)
        for m in np.flatnonzero(gap <= radius).tolist():
            if y is None and m < k:
                continue
            b = yt[m]
            i, j = np.nonzero(np.bitwise_count(xs[a, None] ^ ys[None, b]) <= radius)
            parts.link(xo[a][i], yo[b][j] + shift)
    at = np.flatnonzero(parts.label != np.arange(len(both)))
    return both[at], both[parts.label[at]]


def _compare(radius: int):
    def values(column: pa.ListArray, row: int) -> np.ndarray:
        return column[row].values.to_numpy(zero_copy_only=False).view(np.uint64)

    def run(batches):
        for batch in batches:
            same, xs, ys = batch.columns
            for row in range(batch.num_rows):
                x = values(xs, row)
                a, b = near_in_tiles(x, None if same[row].as_py() else values(ys, row), radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def links(classes: DataFrame, radius: int) -> DataFrame:
    """(a, b): links among the distinct ``fp`` of ``classes`` that connect
    exactly those that chains of pairs within the radius connect."""
    if not 0 <= radius <= _ROOM:
        raise ValueError(f"radius must be from 0 to {_ROOM}")
    named = classes.select("fp", _cell("fp").alias("cell"))
    # at most 17^4 cells, so their sizes may be broadcast
    sizes = named.groupBy("cell").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    tiles = stage(
        named.join(F.broadcast(sizes), "cell")
        .groupBy("cell", F.pmod(F.xxhash64("fp"), F.col("tiles")).alias("tile"))
        .agg(F.collect_list("fp").alias("fps")),
        "tiles",
    )
    x = tiles.select("cell", "tile", F.explode(F.array(*[F.lit(s).cast("bigint") for s in cell_steps(radius)])).alias("step"))
    y = tiles.select(F.col("cell").alias("cell2"), F.col("tile").alias("tile2"))
    pairs = x.join(y, F.col("cell") + F.col("step") == F.col("cell2")).filter("step > 0 OR tile <= tile2")
    met = (
        pairs.join(tiles.select("cell", "tile", F.col("fps").alias("x")), ["cell", "tile"])
        .join(tiles.select(F.col("cell").alias("cell2"), F.col("tile").alias("tile2"), F.col("fps").alias("y")), ["cell2", "tile2"])
        .select(((F.col("cell") == F.col("cell2")) & (F.col("tile") == F.col("tile2"))).alias("same"), "x", "y")
    )
    return stage(met.mapInArrow(_compare(radius), "a bigint, b bigint"), "links")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    fingerprint is 16 hex digits; component_id the smallest doc_id reachable
    over links.  Texts without words share the fingerprint zero, which links
    like any other.  Repeated rows keep one result row each.  A row without
    doc_id links like any other, but names no component: where no member has
    an id, component_id is null.  Other columns are ignored; an empty table
    gives an empty result."""
    marked = stage(fingerprints(docs, width), "fingerprints")
    classes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    found = components(links(classes, radius)).select(F.col("node").alias("fp"), "component")
    rooted = stage(classes.join(found, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("root")), "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    names = stage(rooted.select("fp", "root").join(named, "root").select("fp", "component_id"), "names")
    return marked.join(names, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
