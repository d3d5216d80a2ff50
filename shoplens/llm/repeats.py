"""Removal of repeated byte strings (operator 10).

Every start of a ``depth``-byte window is a suffix to be ordered by its first
``depth`` bytes only, by a most-significant-digit radix sort; windows that are
still equal after the last digit are exactly the repeated ones.

The digits are read in an order chosen from the window's own bytes, which is
allowed since only equality counts and equal windows make equal choices:

1. the window's *anchor*, its least-hashed ``gram``-byte string (leftmost of
   equals).  Neighbouring windows share anchors, so one row stands for a run
   of windows, and this pass moves about 2 / (depth - gram) rows a byte;
   a run whose anchor occurs nowhere else drops out here;
2. the anchor's offset in the window;
3. the window's bytes, a quarter of the depth a digit (as 64-bit polynomial
   hashes, 256 bits over the window); groups of one drop out after each pass.

Runs of one anchor meet in one group.  Groups of up to ``group`` runs are
sorted inside a task.  The windows of larger ones are dealt out one by one by
the whole key (anchor, offset and all digits), where partial aggregation
combines equal windows before the shuffle; so no task gathers a hot group.
Documents with equal texts are counted once and come back at the end."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .near_dedup import mix

DEPTH, GRAM, GROUP = 400, 200, 256
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PART = 1 << 20  # bytes hashed at a time; positions fit into 20 bits
#: A 64-bit value for each byte.
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class _Rolling:
    """Hashes of all substrings of one length, by prefix sums modulo 2^64."""

    def __init__(self, n: int = 1 << 12):
        self.grow(n)

    def grow(self, n: int) -> None:
        self.up, self.down = _powers(_BASE, n), _powers(_BACK, n)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.up):
            self.grow(2 * len(data))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * self.up[: len(data)], out=out[1:])
        return out

    def at(self, prefix: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
        return mix((prefix[starts + width] - prefix[starts]) * self.down[starts])


_ROLL = _Rolling()


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: running minima of blocks, from
    either end."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def anchors(data: np.ndarray, depth: int, gram: int):
    """Runs of window starts [lo, hi] with one anchor: (hash, position, lo, hi)."""
    out = []
    windows = len(data) - depth + 1
    step = _PART - depth
    for begin in range(0, max(0, windows), step):
        n = min(step, windows - begin)
        part = data[begin : begin + n + depth - 1]
        prefix = _ROLL.prefix(part)
        h = _ROLL.at(prefix, np.arange(len(part) - gram + 1), gram)
        low = np.uint64(_PART - 1)
        least = _sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), depth - gram + 1)
        at = (least & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.concatenate([first[1:], [n]]) - 1
        out.append((h[at[first]], begin + at[first], begin + first, begin + last))
    if not out:
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _digits(prefix: np.ndarray, starts: np.ndarray, depth: int) -> list[np.ndarray]:
    """Four digits of each window; the last takes what the others leave."""
    width = depth // 4
    parts = [(k * width, width if k < 3 else depth - 3 * width) for k in range(4)]
    return [_ROLL.at(prefix, starts + a, w) for a, w in parts]


def radix_repeats(group: np.ndarray, digits) -> np.ndarray:
    """Indexes of the windows that have an equal: pass by pass, windows of one
    group are split by the next digit and those left alone drop out.
    ``digits(k, alive)`` gives digit k of the windows ``alive``."""
    alive = np.arange(len(group))
    for k in range(-1, 4):
        if not len(alive):
            break
        if k >= 0:
            key = mix(group) ^ digits(k, alive)
            order = np.lexsort((key, group))
            g, d = group[order], key[order]
            new = np.concatenate([[True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])])
        else:
            order = np.argsort(group, kind="stable")
            g = group[order]
            new = np.concatenate([[True], g[1:] != g[:-1]])
        number = np.cumsum(new) - 1
        size = np.bincount(number)[number]
        keep = size > 1
        alive, group = alive[order[keep]], number[keep].astype(np.uint64)
    return np.sort(alive)


def _runs_of(starts: np.ndarray) -> list[tuple[int, int]]:
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.concatenate([[0], cut + 1])].tolist(), starts[np.concatenate([cut, [len(starts) - 1]])].tolist(), strict=True))


_RUNS = pa.schema([("hash", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.binary()), ("at", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])
RUNS_SQL = "hash bigint, doc_id bigint, digest binary, at bigint, lo bigint, hi bigint"


def _anchor_rows(depth: int, gram: int):
    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                cols: dict[str, list] = {f.name: [] for f in _RUNS}
                part = batch.slice(begin, 256)
                counts, ids, marks = [], [], []
                for i, mark, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                    h, at, lo, hi = anchors(np.frombuffer(text.as_buffer() or b"", np.uint8), depth, gram)
                    counts.append(len(h))
                    ids.append(i)
                    marks.append(mark)
                    for name, x in (("hash", h.view(np.int64)), ("at", at), ("lo", lo), ("hi", hi)):
                        cols[name].append(x)
                take = np.repeat(np.arange(len(counts)), counts)
                arrays = [pa.array(np.concatenate(cols["hash"])), pa.array(ids, pa.int64()).take(pa.array(take)), pa.array(marks, pa.binary()).take(pa.array(take))]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(np.concatenate(cols[n])) for n in ("at", "lo", "hi")], schema=_RUNS)

    return run


def _context_rows(depth: int):
    """A row for each run: the bytes that its windows span."""
    names = ["hash", "big", "nr", "lo", "at", "span"]
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches):
        for batch in batches:
            for nr, text, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                data = memoryview(text.as_buffer())
                rows = [
                    (r["hash"], r["big"], nr, r["lo"], r["at"], bytes(data[r["lo"] : r["hi"] + depth]))
                    for r in runs.as_py()
                ]
                for begin in range(0, len(rows), 2000):
                    cols = list(zip(*rows[begin : begin + 2000], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    return run


class _Windows:
    """The windows of some runs, over one buffer."""

    def __init__(self, spans: list[bytes], depth: int):
        sizes = np.array([len(s) for s in spans], np.int64)
        self.counts = sizes - depth + 1
        base = np.cumsum(sizes) - sizes
        self.row = np.repeat(np.arange(len(spans)), self.counts)
        self.inside = np.arange(len(self.row)) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)
        self.starts = base[self.row] + self.inside
        self.prefix, self.depth = _ROLL.prefix(np.frombuffer(b"".join(spans), np.uint8)), depth

    def digit(self, k: int, some: np.ndarray) -> np.ndarray:
        width = self.depth // 4
        return _ROLL.at(self.prefix, self.starts[some] + k * width, width if k < 3 else self.depth - 3 * width)


def _spans(rows: list[tuple], windows: _Windows, found: np.ndarray) -> tuple[list, list, list]:
    """(text's number, first byte, end) of runs of repeated windows."""
    texts, firsts, ends = [], [], []
    if len(found):
        which = windows.row[found]
        cut = np.flatnonzero((np.diff(which) != 0) | (np.diff(windows.inside[found]) > 1))
        begin, end = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(found) - 1]])
        for b, e in zip(begin.tolist(), end.tolist(), strict=True):
            row = rows[which[b]]
            texts.append(row[1])
            firsts.append(row[2] + int(windows.inside[found[b]]))
            ends.append(row[2] + int(windows.inside[found[e]]) + windows.depth)
    return texts, firsts, ends


_SPANS = pa.schema([("nr", pa.int64()), ("first", pa.int64()), ("end", pa.int64())])


def _sorted_groups(depth: int, most: int = 1_000_000):
    """Rows come sorted by anchor; whole groups are sorted together, about
    ``most`` bytes at a time (a group has a bounded number of runs)."""

    def flush(rows):
        windows = _Windows([r[4] for r in rows], depth)
        anchor = np.array([r[0] for r in rows], np.int64).view(np.uint64)
        offset = np.array([r[3] - r[2] for r in rows], np.int64)
        group = mix(anchor[windows.row] + _BASE * (offset[windows.row] - windows.inside).astype(np.uint64))
        found = radix_repeats(group, windows.digit)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _spans(rows, windows, found)], schema=_SPANS)

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= most and row[0] != rows[-1][0]:
                    yield flush(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
        if rows:
            yield flush(rows)

    return run


def _window_rows(depth: int):
    """Every window of a large group, keyed by all its digits."""
    names = ["k1", "k2", "nr", "start"]

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                hashes, numbers, los, ats, spans = (c.to_pylist() for c in batch.slice(begin, 500).columns)
                windows = _Windows(spans, depth)
                some = np.arange(len(windows.row))
                one = np.array(hashes, np.int64).view(np.uint64)[windows.row]
                offset = np.array(ats, np.int64)[windows.row] - np.array(los, np.int64)[windows.row] - windows.inside
                two = mix(offset.astype(np.uint64) + _BASE)
                for k in range(4):
                    digit = windows.digit(k, some)
                    one, two = mix(one ^ digit) + _BASE, mix(two + digit * _BACK) ^ one
                start = np.array(los, np.int64)[windows.row] + windows.inside
                nr = pa.array(numbers, pa.int64()).take(pa.array(windows.row))
                yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), nr, pa.array(start)], names)

    return run


def _cut_rows(batches):
    """What is left of each text after its spans."""
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("kept", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64())])
    for batch in batches:
        out = []
        for doc, digest, text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
            data = text.as_buffer().to_pybytes()
            parts, end, removed, n, reach = [], 0, 0, 0, -1
            for first, stop in sorted((s["first"], s["end"]) for s in spans):
                if first > reach:  # a new maximal run
                    n += 1
                    parts.append(data[end:first])
                    begin = first
                else:
                    begin = reach
                if stop > reach:
                    removed += stop - begin
                    reach = end = stop
            parts.append(data[end:])
            out.append((doc, digest, b"".join(parts), removed, n))
        for begin in range(0, len(out), 500):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[begin : begin + 500], strict=True), schema, strict=True)], schema=schema)


def _bytes(docs: DataFrame) -> DataFrame:
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return docs.select("doc_id", text.alias("body")).withColumn("digest", F.unhex(F.sha2("body", 256)))


def _start_spans(depth: int):
    def run(batches):
        for batch in batches:
            for nr, starts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                runs = _runs_of(np.sort(np.asarray(starts.values)))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ([nr] * len(runs), [a for a, _ in runs], [b + depth for _, b in runs])], schema=_SPANS)

    return run


def _null_safe(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def cut_texts(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """What is removed, in two tables: (digest, one, copies) for every text,
    with one of its ids and how often it occurs, and (doc_id, digest, kept,
    n_removed, n_spans) for texts that occur once and lose something."""
    body = _bytes(docs)
    copies = stage(body.groupBy("digest").agg(F.min("doc_id").alias("one"), F.count(F.lit(1)).alias("copies")), "copies")
    long_texts = body.filter(F.length("body") >= depth).select("doc_id", "digest", "body")
    runs = stage(long_texts.mapInArrow(_anchor_rows(depth, gram), RUNS_SQL), "runs")
    # Copies of one text count as one place here: they go whole, below.
    place = F.xxhash64("digest", "at")
    met = stage(
        runs.select("hash", place.alias("place"))
        .groupBy("hash")
        .agg(F.min("place").alias("p"), F.max("place").alias("q"), F.count(F.lit(1)).alias("n"))
        .filter("p <> q")
        .select("hash", (F.col("n") > group).alias("big")),
        "met",
    )
    ones = copies.select(F.col("digest").alias("d"), "one", "copies")
    live = stage(
        runs.join(met, "hash")
        .join(ones, (F.col("digest") == F.col("d")) & _null_safe("doc_id", "one"))
        .groupBy(F.col("doc_id").alias("id"), "d", "copies")
        .agg(F.collect_set(F.struct("hash", "big", "at", "lo", "hi")).alias("runs")),
        "live",
    )
    # An id may have many texts: from here on each goes by a number, which is written.
    found_in = stage(
        long_texts.join(live, _null_safe("doc_id", "id") & (F.col("digest") == F.col("d")))
        .select("doc_id", "digest", "copies", "body", "runs", F.monotonically_increasing_id().alias("nr")),
        "texts",
    )
    context = stage(
        found_in.select("nr", "body", "runs").mapInArrow(
            _context_rows(depth), "hash bigint, big boolean, nr bigint, lo bigint, at bigint, span binary"
        ),
        "context",
    )
    columns = ["hash", "nr", "lo", "at", "span"]
    spans_sql = "nr bigint, first bigint, end bigint"
    small = context.filter("NOT big").select(*columns).repartition("hash").sortWithinPartitions("hash")
    found = small.mapInArrow(_sorted_groups(depth), spans_sql)
    windows_sql = "k1 bigint, k2 bigint, nr bigint, start bigint"
    large = stage(context.filter("big").select(*columns).mapInArrow(_window_rows(depth), windows_sql), "windows")
    equal = large.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k1", "k2")
    hits = large.join(stage(equal, "equal"), ["k1", "k2"], "left_semi")
    hits = hits.groupBy("nr").agg(F.collect_set("start").alias("starts"))
    spans = found.unionAll(hits.mapInArrow(_start_spans(depth), spans_sql))
    per_text = stage(spans.groupBy("nr").agg(F.collect_set(F.struct("first", "end")).alias("spans")), "spans")
    cut = (
        found_in.filter("copies = 1")
        .select("nr", "doc_id", "digest", "body")
        .join(per_text, "nr")
        .select("doc_id", "digest", "body", "spans")
        .mapInArrow(_cut_rows, "doc_id bigint, digest binary, kept binary, n_removed bigint, n_spans bigint")
    )
    return copies, cut


def removal_report(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """Per row of ``docs``: (doc_id, n_bytes, n_removed, n_spans, kept_sha256)
    after cutting every byte that lies in a ``depth``-byte string of the UTF-8
    texts which also starts anywhere else, same document included.

    A null text is empty; texts shorter than ``depth`` lose nothing.  Repeated
    rows are copies of each other, so long ones go whole.  A null doc_id is an
    id like any other; rows of one id with unlike texts are kept apart by
    their texts.  Other columns are ignored; an empty table gives an empty
    result.  Texts are not shuffled for rows that lose nothing."""
    copies, cut = cut_texts(docs, depth, gram, group)
    changed = stage(
        cut.select(
            F.col("doc_id").alias("id"), F.col("digest").alias("d"), F.sha2("kept", 256).alias("sha"), "n_removed", "n_spans"
        ),
        "changed",
    )
    plain = _bytes(docs).select("doc_id", "digest", F.length("body").cast("bigint").alias("n_bytes"))
    many = copies.filter("copies > 1").select(F.col("digest").alias("m"))
    whole = F.col("m").isNotNull() & (F.col("n_bytes") >= depth)
    joined = plain.join(many, F.col("digest") == F.col("m"), "left").join(
        changed, _null_safe("doc_id", "id") & (F.col("digest") == F.col("d")), "left"
    )
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest()))
        .otherwise(F.coalesce("sha", F.lower(F.hex("digest"))))
        .alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """``docs`` (doc_id, text) with a binary column ``kept``: what remains of
    the text's bytes.  The rules are those of ``removal_report``."""
    copies, cut = cut_texts(docs, depth, gram, group)
    cut = stage(cut.select(F.col("doc_id").alias("id"), F.col("digest").alias("d"), "kept"), "cut")
    many = copies.filter("copies > 1").select(F.col("digest").alias("m"))
    body = _bytes(docs)
    joined = body.join(many, F.col("digest") == F.col("m"), "left").join(
        cut, _null_safe("doc_id", "id") & (F.col("digest") == F.col("d")), "left"
    )
    whole = F.col("m").isNotNull() & (F.length("body") >= depth)
    kept = F.when(whole, F.lit(b"")).otherwise(F.coalesce("kept", "body")).alias("kept")
    return joined.select("doc_id", F.decode("body", "UTF-8").alias("text"), kept)
