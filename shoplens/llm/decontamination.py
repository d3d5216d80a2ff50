"""Benchmark decontamination (operator 1).

The test items (in parts of at most ``PART`` words) form a BM25 inverted
index; every passage of every document is a query.  A part's impacts are
divided by its score for itself, so a passage that holds the whole part scores
1 whatever the part, and ``THRESHOLD`` means the same for all.  Passages are
windows of 2 * PART words, half overlapping, so a part that stands in a text
stands whole in some passage.

Retrieval of everything above the threshold, by block-max WAND:

* postings lie in blocks of ``BLOCK`` parts with the largest impact a term has
  in the block.  Terms with next to no impact are non-essential: their sum
  over a part bounds what they add.  For all passages of a slice at once, the
  block bounds of the essential terms are summed; a (passage, block) whose
  bound stays below the threshold is skipped;
* in the blocks left, cursors over the passage's terms move in order of the
  parts; a pivot is where the summed bounds reach the threshold, and only
  pivots are scored in full.

Retrieved pairs are verified on the words themselves: an item's last sentence
is its answer, the rest its question, and both must overlap the document
around the passage by ``OVERLAP`` of their three-word shingles.

The benchmark goes to the tasks in shards of bounded size, one scan of the
corpus each (one shard unless the benchmark exceeds ``SHARD_CHARS``
characters); the corpus is never shuffled."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage
from .license_scan import words_of

PART, BLOCK, THRESHOLD, OVERLAP = 64, 4, 0.7, 0.6
SHARD_CHARS = 20_000_000
K1, B = 1.2, 0.75
_SENTENCE = re.compile(r"(?<=[.?!])\s+|\n+")


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """Words of an item's question and answer: the last sentence that has words
    is the answer, unless it is the only one."""
    parts = [w for w in (words_of(s) for s in _SENTENCE.split(text)) if w]
    if not parts:
        return [], []
    if len(parts) == 1:
        return parts[0], []
    return [w for p in parts[:-1] for w in p], parts[-1]


def _grams(words: list[bytes], n: int = 3) -> set[tuple]:
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def overlap(part: list[bytes], passage: list[bytes]) -> float:
    """Share of a part's shingles (three words, or all of fewer) in a passage."""
    grams = _grams(part)
    if not grams:
        return 1.0
    n = len(next(iter(grams)))
    return len(grams & {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}) / len(grams)


def item_parts(words: list[bytes], size: int = PART) -> list[list[bytes]]:
    """Parts of nearly equal length, of at most ``size`` words."""
    n = -(-len(words) // size)
    return [words[len(words) * k // n : len(words) * (k + 1) // n] for k in range(n)]


@dataclass
class Index:
    """Impacts by term; parts are numbered in the order of the items."""

    items: list  # item ids, by item number
    item_of: np.ndarray  # item number of each part
    questions: list[tuple[list[bytes], list[bytes]]]
    vocabulary: dict[bytes, int] = field(default_factory=dict)  # term: number from 1 on
    postings: list[list[tuple[int, float]]] = field(default_factory=list)  # by term: (part, impact)
    block_start: np.ndarray | None = None  # postings of blocks, of essential terms
    block_of: np.ndarray | None = None
    block_max: np.ndarray | None = None
    slack: float = 0.0  # what non-essential terms can add at most


def build(items: list[tuple], frequency: dict[bytes, int], n_parts: int, mean: float, block: int = BLOCK) -> Index:
    """``items``: (id, text); ``frequency``: in how many parts a term occurs;
    ``n_parts`` and ``mean`` length: of all parts, of all shards."""
    index = Index([i for i, _ in items], np.zeros(0, np.int64), [question_answer(t) for _, t in items])
    owner, by_term = [], {}
    for number, (_, text) in enumerate(items):
        words = words_of(text)
        for part in item_parts(words) if words else []:
            counts: dict[bytes, int] = {}
            for w in part:
                counts[w] = counts.get(w, 0) + 1
            impact = {}
            for w, c in counts.items():
                df = max(1, frequency.get(w, 1))
                idf = math.log(1 + (n_parts - df + 0.5) / (df + 0.5))
                impact[w] = idf * c * (K1 + 1) / (c + K1 * (1 - B + B * len(part) / mean))
            total = sum(impact.values())
            k = len(owner)
            owner.append(number)
            for w, x in impact.items():
                by_term.setdefault(w, []).append((k, x / total))
    index.item_of = np.array(owner, np.int64)
    # Non-essential: frequent terms; a part's sum of them is the slack.
    common = {w for w in by_term if frequency.get(w, 1) * 8 > n_parts}
    sums = np.zeros(len(owner))
    for w in sorted(common, key=lambda w: (-frequency.get(w, 1), w)):
        rows = by_term[w]
        if all(sums[k] + x < 0.25 for k, x in rows):
            for k, x in rows:
                sums[k] += x
        else:
            common.discard(w)
    index.slack = float(sums.max(initial=0.0))
    starts, blocks, most = [0, 0], [], []
    index.postings.append([])
    for number, (w, rows) in enumerate(sorted(by_term.items()), 1):
        index.vocabulary[w] = number
        index.postings.append(rows)
        if w not in common:
            best: dict[int, float] = {}
            for k, x in rows:
                best[k // block] = max(best.get(k // block, 0.0), x)
            blocks += best
            most += best.values()
        starts.append(len(blocks))
    index.block_start = np.array(starts, np.int64)
    index.block_of, index.block_max = np.array(blocks, np.int64), np.array(most, np.float64)
    return index


def wand(terms: set[int], index: Index, low: int, high: int, threshold: float) -> list[tuple[int, float]]:
    """(part, score) of the parts low..high - 1 that reach the threshold, for
    a passage's distinct terms."""
    cursors = []
    for t in terms:
        rows = [r for r in index.postings[t] if low <= r[0] < high]
        if rows:
            cursors.append([rows, 0, max(x for _, x in rows)])
    out = []
    while cursors:
        cursors.sort(key=lambda c: c[0][c[1]][0])
        bound, pivot = 0.0, None
        for c in cursors:
            bound += c[2]
            if bound >= threshold - 1e-9:
                pivot = c[0][c[1]][0]
                break
        if pivot is None:
            break
        if cursors[0][0][cursors[0][1]][0] == pivot:
            score = sum(c[0][c[1]][1] for c in cursors if c[0][c[1]][0] == pivot)
            if score >= threshold - 1e-9:
                out.append((pivot, min(1.0, score)))
            step = pivot + 1
        else:
            step = pivot
        for c in cursors:
            while c[1] < len(c[0]) and c[0][c[1]][0] < step:
                c[1] += 1
        cursors = [c for c in cursors if c[1] < len(c[0])]
    return out


def retrieve(texts: list[list[bytes]], index: Index, threshold: float, size: int = PART, block: int = BLOCK):
    """(text, first word of the passage, part, score) for every passage and
    part at or above the threshold."""
    if not len(index.item_of):
        return []
    get = index.vocabulary.get
    numbers, place, text_of = [], [], []
    chunk_start, chunks = [], 0
    for i, words in enumerate(texts):
        ids = np.array([get(w, 0) for w in words], np.int64)
        n = max(1, -(-len(words) // size))
        chunk_start.append(chunks)
        hit = np.flatnonzero(ids)
        numbers.append(ids[hit])
        place.append(chunks + hit // size)
        text_of += [i] * n
        chunks += n
    term, chunk = np.concatenate(numbers), np.concatenate(place)
    n_blocks = -(-len(index.item_of) // block)
    # One entry for each distinct term of a chunk.
    pair = np.unique(chunk * (len(index.postings) + 1) + term)
    chunk, term = np.divmod(pair, len(index.postings) + 1)
    n = index.block_start[term + 1] - index.block_start[term]
    ends = np.cumsum(n)
    if not len(ends) or not ends[-1]:
        at = np.zeros(0, np.int64)
    else:
        at = np.repeat(index.block_start[term] - (ends - n), n) + np.arange(ends[-1])
    owner = np.array(text_of)
    out = []
    step = max(1, 4_000_000 // n_blocks)  # bounds held at a time
    cell = np.repeat(chunk, n) * n_blocks + index.block_of[at]
    bounds_at = np.searchsorted(cell, np.arange(0, chunks + step, step) * n_blocks) if len(cell) else None
    for k, begin in enumerate(range(0, chunks, step)):
        last = min(chunks, begin + step + 1)  # one chunk on, for the last passage
        if bounds_at is None:
            break
        lo = np.searchsorted(np.repeat(chunk, n), begin)
        hi = np.searchsorted(np.repeat(chunk, n), last)
        sums = np.bincount(cell[lo:hi] - begin * n_blocks, index.block_max[at[lo:hi]], (last - begin) * n_blocks)
        sums = sums.reshape(-1, n_blocks)
        after = np.zeros_like(sums)
        same = owner[begin + 1 : last] == owner[begin : last - 1]
        after[:-1][same] = sums[1:][same]
        full = sums + after
        full = full[: min(step, chunks - begin)]
        for c, b in zip(*np.nonzero(full >= threshold - index.slack - 1e-9), strict=True):
            text = int(owner[begin + c])
            first = (begin + int(c) - chunk_start[text]) * size
            words = texts[text][first : first + 2 * size]
            terms = {t for t in (get(w, 0) for w in words) if t}
            out += [(text, first, p, s) for p, s in wand(terms, index, int(b) * block, (int(b) + 1) * block, threshold)]
    return out


_OUT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])
_OUT_SQL = "doc_id bigint, item_id bigint, first_word bigint, end_word bigint, score double, question_overlap double, answer_overlap double"


def _verified(texts: list[list[bytes]], index: Index, threshold: float, least: float):
    """Best verified passage of each (text, item)."""
    best: dict[tuple[int, int], tuple] = {}
    for text, first, part, score in retrieve(texts, index, threshold):
        item = int(index.item_of[part])
        question, answer = index.questions[item]
        # An item may be longer than its part: look as far as it can reach.
        reach = max(0, len(question) + len(answer) - PART)
        begin, end = max(0, first - reach), min(len(texts[text]), first + 2 * PART + reach)
        words = texts[text][begin:end]
        q, a = overlap(question, words), overlap(answer, words)
        if q >= least and a >= least:
            row = (score, q + a, -first, begin, end, q, a)
            if (text, item) not in best or row > best[text, item]:
                best[text, item] = row
    return best


def _scan(shipped, threshold: float, least: float):
    def run(batches):
        index = shipped.value
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for begin, end in slices(batch, texts, 1_000_000):
                words = [words_of(t) for t in texts[begin:end]]
                cols: list[list] = [[] for _ in _OUT]
                for (text, item), (score, _, _, first, stop, q, a) in sorted(_verified(words, index, threshold, least).items()):
                    for col, x in zip(cols, (ids[begin + text], index.items[item], first, stop, score, q, a), strict=True):
                        col.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _OUT, strict=True)], schema=_OUT)

    return run


def _shards(benchmark: DataFrame, shard_chars: int) -> list[Index]:
    """Indexes of the benchmark's items, each over a bounded number of
    characters; term statistics are over all items."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // shard_chars))
    if n == 1:
        groups = [items.collect()]
    else:
        dealt = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * n)))
        groups = [dealt.filter(F.col("shard") == k).select("item_id", "text").collect() for k in range(2 * n)]
    frequency: dict[bytes, int] = {}
    n_parts = length = 0
    if n > 1:
        made = stats(items)
        n_parts, length = made.agg(F.max("parts"), F.max("words")).first()
    out = []
    for rows in groups:
        rows = sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        if n == 1:
            for _, text in rows:
                words = words_of(text)
                for part in item_parts(words) if words else []:
                    n_parts, length = n_parts + 1, length + len(part)
                    for w in set(part):
                        frequency[w] = frequency.get(w, 0) + 1
        else:
            own = {w for _, text in rows for w in words_of(text)}
            frequency = {bytes(r.token): r.n for r in made.filter(F.col("token").isin([bytearray(w) for w in own])).collect()}
        out.append(build(rows, frequency, n_parts, length / max(1, n_parts)))
    return out


def stats(items: DataFrame) -> DataFrame:
    """(token, n, parts, words): parts that hold the token; all parts; words."""

    def run(batches):
        from collections import Counter

        counts: Counter = Counter()
        parts = length = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                for part in item_parts(words) if words else []:
                    counts.update(set(part))
                    parts, length = parts + 1, length + len(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*counts, b""], pa.binary()), pa.array([*counts.values(), 0], pa.int64()),
             pa.array([0] * len(counts) + [parts], pa.int64()), pa.array([0] * len(counts) + [length], pa.int64())],
            ["token", "n", "parts", "words"],
        )

    counts = items.select("text").mapInArrow(run, "token binary, n bigint, parts bigint, words bigint")
    return stage(counts.groupBy("token").agg(*[F.sum(c).alias(c) for c in ("n", "parts", "words")]), "terms")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP, shard_chars: int = SHARD_CHARS
) -> DataFrame:
    """(doc_id, item_id, first_word, end_word, score, question_overlap,
    answer_overlap): the best verified passage of every document row and item.

    An item is matched by the words it has, however few: one of a single word
    marks every document that holds that word, so short items are the caller's
    to leave out.  Null or wordless texts and items match nothing; repeated rows each give
    their rows, repeated items theirs; of passages that tie, the first counts;
    a null id is carried along; other columns are ignored; an empty table on
    either side gives an empty result."""
    context = docs.sparkSession.sparkContext
    found = None
    for index in _shards(benchmark, shard_chars):
        part = docs.select("doc_id", "text").mapInArrow(_scan(context.broadcast(index), threshold, least), _OUT_SQL)
        found = part if found is None else found.unionAll(part)
    return found


def _drop(shipped, threshold: float, least: float):
    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            keep = np.ones(len(texts), bool)
            for begin, end in slices(batch, texts, 1_000_000):
                words = [words_of(t) for t in texts[begin:end]]
                for text, _ in _verified(words, shipped.value, threshold, least):
                    keep[begin + text] = False
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([c.filter(mask) for c in batch.columns[1:]], batch.schema.names[1:])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    context, names = docs.sparkSession.sparkContext, docs.columns
    for index in _shards(benchmark, SHARD_CHARS):
        rows = docs.select(F.col("text").alias("_llm_text"), *names)
        docs = rows.mapInArrow(_drop(context.broadcast(index), threshold, least), docs.schema)
    return docs
