"""Alignment of two tokenizers over the same texts (operator 13).

A text, a space put before it, is encoded by a byte-level BPE file (A) and a
sentence-piece BPE model (B).  Where tokens of both end at one byte they are
linked, and such offsets cut the tokens into groups.  How often a pair of ids
is linked in the whole corpus, and whether that is the most for its B id,
comes back to every document.

*Words.*  Neither tokenizer joins anything across a space that follows a
non-space and precedes a non-space, so tokens of both end before it and the
parts between such spaces are encoded, aligned and written out once each.

*External spill counting.*  A task turns its links into records (B id, A id,
document, times), radix-partitioned by B id, sorted, and spilled as zstd runs
of at most ``RECORDS`` links.  Records of a pair lie together; what travels is
one head for all of them, so a pair that every document has costs one head a
run.  Each partition's runs meet as a stream of blocks ordered by first key:
open blocks wait in a heap by last key, and whenever the heap's least key (or
the next block's first) closes B ids, their heads are merged and counted.  The
order is B id first, so an id's largest count is known when it closes, and the
answers go back to the runs in the runs' own order; there they are added up
over the records' documents.  Memory is one block for each run that overlaps
the cut, and the heads of one B id.
"""

from __future__ import annotations

import copy
import hashlib
import heapq
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage, take_over
from .tokens import byte_letters, default_path

PIECE_FILE = "piece_bpe_32k.model"
#: Links after which a task spills its records, and heads of a run's block.
RECORDS, BLOCK = 1_000_000, 8_192
LEAST_BUCKETS = 64
#: Words kept by a worker, and the longest kept.
WORDS, LONGEST = 500_000, 32
_ID, _DOC = 20, 24  # bits of a token id and of a document's number in its run
_CUT = re.compile(r"(?<=[^ ])(?= \S)")
_ODD = re.compile(r" (?:\s|\Z)")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECE_FILE)


# --- arrays as zstd ------------------------------------------------------------------

def pack(values: np.ndarray) -> bytes:
    """An array as zstd, its bytes ordered by their place in the number."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


# --- tokens of words -------------------------------------------------------------------

class _Vocabulary:
    """Bytes and decimal spelling of ids."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.size = np.array([len(t) for t in tokens], np.int64)
        spelled = [str(i).encode() for i in range(len(tokens))]
        self.digits = np.frombuffer(b"".join(spelled), np.uint8)
        self.n_digits = np.array([len(s) for s in spelled], np.int64)
        self.at = np.cumsum(self.n_digits) - self.n_digits

    def joined(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


class Aligner:
    """Aligns words; one per Python worker and pair of files.

    A word's number leads to its counts of A and B tokens, its links and its
    groups as written; ``fits`` tells whether both give back its bytes."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        tokens = [b""] * (self.a.get_vocab_size(with_added_tokens=True) + 1)
        for token, i in vocabulary.items():
            tokens[i] = bytes(letters[c] for c in token if c in letters)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece of the model spans words")
        as_bytes = [
            bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces
        ]
        if max(len(tokens), len(pieces)) > 1 << _ID:
            raise ValueError(f"ids must have at most {_ID} bits")
        self.a_tokens, self.b_tokens = _Vocabulary(tokens), _Vocabulary(as_bytes)
        self.b_space = self.b.piece_to_id("▁")
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.fits, self.n_a, self.n_b, self.n_links = array("b"), array("q"), array("q"), array("q")
        self.links, self.written = array("Q"), []

    def _b_ids(self, words: list[str]) -> list[list[int]]:
        # the model puts a space before a text, but not before an empty one
        return [ids or [self.b_space] for ids in self.b.encode(words, num_threads=1)]

    def add(self, words: list[str]) -> None:
        """Number the words, given without the space before them."""
        for first in range(0, len(words), 20_000):
            self._add(words[first : first + 20_000])

    def _add(self, words: list[str]) -> None:
        a = [e.ids for e in self.a.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]
        b = self._b_ids(words)
        fits = [
            (data := (" " + w).encode("utf-8", "surrogatepass")) == self.a_tokens.joined(x) and data == self.b_tokens.joined(y)
            for w, x, y in zip(words, a, b, strict=True)
        ]
        self.number.update(zip(words, range(len(self.written), len(self.written) + len(words)), strict=True))
        n_a = np.array([len(x) if f else 0 for x, f in zip(a, fits, strict=True)], np.int64)
        n_b = np.array([len(x) if f else 0 for x, f in zip(b, fits, strict=True)], np.int64)
        flat_a = np.array([i for x, f in zip(a, fits, strict=True) if f for i in x], np.int64)
        flat_b = np.array([i for x, f in zip(b, fits, strict=True) if f for i in x], np.int64)
        end_a, end_b = np.cumsum(self.a_tokens.size[flat_a]), np.cumsum(self.b_tokens.size[flat_b])
        meet_a, meet_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
        bounds = np.concatenate([[0], np.cumsum(n_a)])
        n_links = np.diff(np.concatenate([[0], np.cumsum(meet_a)])[bounds])
        self.fits.extend(fits)
        self.n_a.extend(n_a.tolist())
        self.n_b.extend(n_b.tolist())
        self.n_links.extend(n_links.tolist())
        keys = (flat_b[meet_b].astype(np.uint64) << np.uint64(_ID)) | flat_a[meet_a].astype(np.uint64)
        self.links.frombytes(keys.tobytes())
        self.written += self._written(flat_a, flat_b, meet_a, meet_b, n_a + n_b)

    def _written(self, flat_a, flat_b, meet_a, meet_b, n_tokens) -> list[bytes]:
        """Groups as ``a1,a2|b1;a3|b2,b3`` of every word."""
        group = np.concatenate([2 * (np.cumsum(meet_a) - meet_a), 2 * (np.cumsum(meet_b) - meet_b) + 1])
        order = np.argsort(group, kind="stable")
        va, vb = self.a_tokens, self.b_tokens
        n = np.concatenate([va.n_digits[flat_a], vb.n_digits[flat_b]])[order]
        at = np.concatenate([va.at[flat_a], vb.at[flat_b] + len(va.digits)])[order]
        last = np.concatenate([np.where(meet_a, ord("|"), ord(",")), np.where(meet_b, ord(";"), ord(","))])[order]
        ends = np.cumsum(n + 1)
        digits = np.concatenate([va.digits, vb.digits, [0]])
        room = np.repeat(at - (ends - n - 1), n + 1) + np.arange(ends[-1] if len(ends) else 0)
        room[ends - 1] = 0
        out = digits[room].astype(np.uint8)
        out[ends - 1] = last
        data, stop = out.tobytes(), np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n_tokens)])].tolist()
        return [data[x : max(x, y - 1)] for x, y in zip(stop[:-1], stop[1:], strict=True)]

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the words of all texts, where each text's begin)."""
        if len(self.written) > WORDS:
            self.clear()
        words, bounds = [], [0]
        for text in texts:
            if text:
                spaced = " " + text
                words += [p[1:] for p in _CUT.split(spaced)] if _ODD.search(spaced) else text.split(" ")
            bounds.append(len(words))
        new = [w for w in dict.fromkeys(words) if w not in self.number]
        self.add(new)
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        for w in new:
            if len(w) > LONGEST:
                del self.number[w]
        return numbers, np.array(bounds, np.int64)

    def whole(self, text: str):
        """(n_a, n_b, link keys, groups) of a text taken as one word, or None."""
        alone = copy.copy(self)
        alone.clear()
        alone.add([text])
        return (alone.n_a[0], alone.n_b[0], np.array(alone.links), alone.written[0]) if alone.fits[0] else None


@lru_cache(maxsize=1)
def _aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


# --- records and runs ---------------------------------------------------------------------

_SPILL = pa.schema(
    [
        ("run", pa.int64()), ("bucket", pa.int32()), ("first", pa.int64()), ("heads", pa.binary()), ("times", pa.binary()),
        ("records", pa.binary()), ("doc_id", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())),
        ("n_links", pa.list_(pa.int64())), ("digest", pa.list_(pa.string())),
    ]
)
_SPILL_SQL = (
    "run bigint, bucket int, first bigint, heads binary, times binary, records binary, doc_id array<bigint>, "
    "n_a array<bigint>, n_b array<bigint>, n_links array<bigint>, digest array<string>"
)


class _Run:
    """Documents of a task and their links until they are spilled."""

    def __init__(self, limit: int, block: int):
        self.limit, self.block = limit, block
        self.doc_id, self.n_a, self.n_b, self.n_links, self.digest = [], [], [], [], []
        self.keys, self.docs, self.size = [], [], 0

    def take(self, ids: list, texts: list[str], aligner: Aligner) -> None:
        numbers, bounds = aligner.texts(texts)
        fits, n_a, n_b, n_links = (np.array(x) for x in (aligner.fits, aligner.n_a, aligner.n_b, aligner.n_links))
        first = np.cumsum(n_links) - n_links
        links = np.array(aligner.links)
        written = aligner.written
        misfit = np.concatenate([[0], np.cumsum(fits[numbers] == 0)])[bounds]
        listed = numbers.tolist()
        for k, (i, text) in enumerate(zip(ids, texts, strict=True)):
            begin, end = bounds[k], bounds[k + 1]
            at = numbers[begin:end]
            if misfit[k] != misfit[k + 1]:  # the text as one word decides
                whole = aligner.whole(text)
                if whole is not None:
                    self._add(i, *whole)
                    continue
                begin, at = end, numbers[:0]
            n = n_links[at]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            keys = links[np.repeat(first[at] - (ends - n), n) + np.arange(total)]
            groups = b";".join([written[w] for w in listed[begin:end]])
            self._add(i, int(n_a[at].sum()), int(n_b[at].sum()), keys, groups)

    def _add(self, i, n_a: int, n_b: int, keys: np.ndarray, groups: bytes) -> None:
        number = len(self.doc_id)
        self.doc_id.append(i)
        self.n_a.append(n_a)
        self.n_b.append(n_b)
        self.n_links.append(len(keys))
        self.digest.append(hashlib.sha256(groups).hexdigest() if n_a else "")
        self.keys.append(keys)
        self.docs.append(np.full(len(keys), number, np.uint64))
        self.size += len(keys) + 1

    @property
    def full(self) -> bool:
        return self.size >= self.limit or len(self.doc_id) >= (1 << _DOC) - 1

    def rows(self, run: int, buckets: int):
        """The run's heads by bucket, in blocks, then its records and documents."""
        keys = np.concatenate([np.zeros(0, np.uint64), *self.keys])
        docs = np.concatenate([np.zeros(0, np.uint64), *self.docs])
        # documents are in order already, so a stable sort by pair orders records
        order = np.argsort(keys, kind="stable")
        keys, docs = keys[order], docs[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(keys))).astype(np.uint32)
        pairs, docs = keys[at], docs[at].astype(np.uint32)
        # radix partitions, B id first within each
        bucket = bucket_of(pairs >> np.uint64(_ID), buckets)
        order = np.argsort(bucket, kind="stable")
        pairs, docs, times, bucket = pairs[order], docs[order], times[order], bucket[order]
        head = np.ones(len(pairs), bool)
        head[1:] = pairs[1:] != pairs[:-1]
        at = np.flatnonzero(head)
        spans = np.diff(np.append(at, len(pairs))).astype(np.uint32)
        pairs, bucket = pairs[at], bucket[at]
        total = np.add.reduceat(times.astype(np.uint64), at) if len(at) else np.zeros(0, np.uint64)
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)).tolist() if len(bucket) else []
        empty = dict.fromkeys(_SPILL.names)
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True) if cuts else ():
            for b in range(begin, end, self.block):
                e = min(b + self.block, end)
                yield empty | {
                    "run": run, "bucket": int(bucket[begin]), "first": int(pairs[b]),
                    "heads": pack(np.diff(pairs[b:e], prepend=np.uint64(0))), "times": pack(total[b:e]),
                }
        yield empty | {
            "run": run, "bucket": -1, "first": -1, "heads": pack(spans), "times": pack(times), "records": pack(docs),
            "doc_id": self.doc_id, "n_a": self.n_a, "n_b": self.n_b, "n_links": self.n_links, "digest": self.digest,
        }


def bucket_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    """The radix partition of B ids, of which frequent ones lie close together."""
    return ((ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % buckets


def _spill(a_path: str, b_path: str, buckets: int, limit: int, block: int):
    def run(batches):
        take_over("aligner", _aligner.cache_clear)
        aligner = _aligner(a_path, b_path)
        context = TaskContext.get()
        name = (context.partitionId() if context else 0) << 32
        held = _Run(limit, block)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for begin, end in slices(batch, texts, 2_000_000):
                held.take(ids[begin:end], texts[begin:end], aligner)
                if held.full:
                    for row in held.rows(name, buckets):
                        yield pa.RecordBatch.from_pylist([row], _SPILL)
                    held, name = _Run(limit, block), name + 1
        if held.doc_id:
            for row in held.rows(name, buckets):
                yield pa.RecordBatch.from_pylist([row], _SPILL)

    return run


# --- the merge ----------------------------------------------------------------------------

class _Block:
    def __init__(self, run: int, bucket: int, first: int, heads: bytes, times: bytes):
        self.run, self.bucket, self.first = run, bucket, first
        self.keys = np.cumsum(unpack(heads, np.uint64), dtype=np.uint64)
        self.times = unpack(times, np.uint64)
        self.done, self.answers = 0, []

    @property
    def last(self) -> int:
        return int(self.keys[-1])

    def take(self, below: int) -> tuple[np.ndarray, np.ndarray]:
        """Heads not yet taken with keys below the cut."""
        end = len(self.keys) if below > self.last else int(np.searchsorted(self.keys, np.uint64(below)))
        begin, self.done = self.done, max(self.done, end)
        return self.keys[begin : self.done], self.times[begin : self.done]

    def answer(self) -> dict:
        return {
            "run": self.run, "bucket": self.bucket, "first": self.first, "answers": pack(np.concatenate(self.answers)),
        }


_ANSWERS = pa.schema([("run", pa.int64()), ("bucket", pa.int32()), ("first", pa.int64()), ("answers", pa.binary())])


class _Merge:
    """Open blocks of one bucket, in a heap by last key."""

    def __init__(self, limit: int):
        self.heap, self.pending, self.number = [], 0, 0
        self.limit, self.wait, self.cut = limit, limit, -1

    def push(self, block: _Block) -> None:
        heapq.heappush(self.heap, (block.last, self.number, block))
        self.number += 1
        self.pending += len(block.keys)

    def due(self, below: int) -> bool:
        """Whether a cut there closes anything and is worth a pass."""
        return below > self.cut and self.pending >= self.wait

    def close(self, below: int):
        """Count all heads with keys below the cut, a multiple of a B id's
        first key; gives the answers of the blocks that are through."""
        blocks = [b for _, _, b in self.heap]
        taken = [b.take(below) for b in blocks]
        sizes = [len(k) for k, _ in taken]
        if sum(sizes):
            keys, at = np.unique(np.concatenate([k for k, _ in taken]), return_inverse=True)
            counts = np.zeros(len(keys), np.uint64)
            np.add.at(counts, at, np.concatenate([t for _, t in taken]))
            ids = keys >> np.uint64(_ID)
            starts = np.flatnonzero(np.diff(ids.astype(np.int64), prepend=-1))
            most = np.repeat(np.maximum.reduceat(counts, starts), np.diff(np.append(starts, len(keys))))
            answers = (counts << np.uint64(1) | (counts == most))[at]
            for block, part in zip(blocks, np.split(answers, np.cumsum(sizes)[:-1]), strict=True):
                block.answers.append(part)
            self.pending -= sum(sizes)
        self.cut, self.wait = below, max(self.limit, 2 * self.pending)
        while self.heap and self.heap[0][0] < below:
            yield heapq.heappop(self.heap)[2].answer()


def _merge(limit: int):
    """Blocks ordered by bucket and first key -> their answers."""

    def rows(batches):
        merge, bucket = _Merge(limit), None
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(*(c[i].as_py() for c in batch.columns))
                if block.bucket != bucket:
                    yield from merge.close(1 << 62)
                    merge, bucket = _Merge(limit), block.bucket
                # later blocks begin no earlier: B ids before this one's are closed
                below = block.first >> _ID << _ID
                if merge.due(below):
                    yield from merge.close(below)
                merge.push(block)
        yield from merge.close(1 << 62)

    def run(batches):
        for row in rows(batches):
            yield pa.RecordBatch.from_pylist([row], _ANSWERS)

    return run


# --- back to the documents -------------------------------------------------------------------

_OUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
        ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string()),
    ]
)
_OUT_SQL = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
    "groups_sha256 string"
)


def _contribute(batches):
    """A run's row, then its answers in order -> its documents' rows."""

    def finish(head: dict, answers: list[bytes]) -> pa.RecordBatch:
        spans, times, docs = (unpack(head[c], np.uint32) for c in ("heads", "times", "records"))
        told = np.concatenate([np.zeros(0, np.uint64), *(unpack(a, np.uint64) for a in answers)])
        told = np.repeat(told, spans)
        n = len(head["n_a"])
        best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(best, docs, times * (told & np.uint64(1)).astype(np.int64))
        np.add.at(total, docs, times * (told >> np.uint64(1)).astype(np.int64))
        columns = [head["doc_id"], head["n_a"], head["n_b"], head["n_links"], head["n_links"], best, total, head["digest"]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT, strict=True)], schema=_OUT)

    head, answers = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["bucket"] < 0:
                if head is not None:
                    yield finish(head, answers)
                head, answers = row, []
            else:
                answers.append(row["answers"])
    if head is not None:
        yield finish(head, answers)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, buckets: int | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)
    for every row of ``docs``.

    n_best counts links whose pair has the largest corpus count of its B id,
    ties included; count_sum adds the counts of all links.  Strings of special
    tokens are ordinary text.  A text that is null, empty, or not given back
    byte for byte by both tokenizers has no tokens: zeros and an empty digest.
    Tokens are not empty, so a group holds one link, its last tokens'.
    Repeated rows count, and keep one result row, each; rows without doc_id are
    documents like any other.  Other columns are ignored; an empty table gives
    an empty result.  ``buckets``: radix partitions of the B ids, by default as
    many as the session's shuffle partitions, 64 at least."""
    spark = docs.sparkSession
    buckets = buckets or max(LEAST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    paths = (a_path or default_path(), b_path or piece_path())
    spilled = stage(docs.select("doc_id", "text").mapInArrow(_spill(*paths, buckets, RECORDS, BLOCK), _SPILL_SQL), "runs")
    blocks = (
        spilled.filter("bucket >= 0")
        .select("run", "bucket", "first", "heads", "times")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "first")
    )
    answers = blocks.mapInArrow(_merge(RECORDS), "run bigint, bucket int, first bigint, answers binary")
    runs = spilled.filter("bucket < 0").withColumn("answers", F.lit(None).cast("binary"))
    back = (
        runs.unionByName(answers, allowMissingColumns=True)
        .repartition("run")
        .sortWithinPartitions("run", "bucket", "first")
    )
    return back.mapInArrow(_contribute, _OUT_SQL)
