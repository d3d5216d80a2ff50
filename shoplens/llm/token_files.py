"""Token-id files with Elias-Fano boundaries (operator 4).

A file holds the ids of consecutive documents as one array (2 bytes an id
where the vocabulary allows, else 4) and, instead of a table of 64-bit
offsets, the documents' ends as an Elias-Fano sequence: the low bits of each
end packed side by side, the high bits in unary, and the place of every 256th
one-bit.  ``select`` answers any offset from there; n documents over m ids
take about n * (2 + log2(m / n)) bits.  Document ids, which ascend, are kept
in the same way.  Files are read back with Spark's binaryFile source."""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_path, stage, take_over, text_slices
from .tokens import default_path, encoder

END_ID = 2
MAGIC = b"SLEF"
_HEAD = struct.Struct("<4sBxxxIQQq")  # magic, id width, null ids, documents, ids, smallest doc_id
_SEQ = struct.Struct("<QBxxxIQ")  # values, low bits, samples, bytes of the unary part
SAMPLE = 256


class EliasFano:
    """A non-decreasing sequence of non-negative integers."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @staticmethod
    def pack(values: np.ndarray) -> bytes:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel())
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        high, samples = np.packbits(bits), ones[::SAMPLE].astype(np.uint32)
        return _SEQ.pack(n, low_bits, len(samples), len(high)) + samples.tobytes() + high.tobytes() + low.tobytes()

    @classmethod
    def unpack(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        n, low_bits, n_samples, n_high = _SEQ.unpack_from(data, at)
        at += _SEQ.size
        samples = np.frombuffer(data, np.uint32, n_samples, at)
        at += 4 * n_samples
        high = np.frombuffer(data, np.uint8, n_high, at)
        at += n_high
        n_low = -(-n * low_bits // 8)
        return cls(n, low_bits, np.frombuffer(data, np.uint8, n_low, at), high, samples), at + n_low

    def _lows(self, begin: int, end: int) -> np.ndarray:
        first = begin * self.low_bits
        bits = np.unpackbits(self.low[first // 8 : -(-end * self.low_bits // 8)])[first % 8 :]
        bits = bits[: (end - begin) * self.low_bits].reshape(end - begin, self.low_bits)
        return (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """Value i: from the nearest sampled one-bit on, count to the i-th."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        left, at = i % SAMPLE, int(self.samples[i // SAMPLE])
        byte = at // 8
        ahead = at % 8
        while True:
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + 64])[ahead:])
            if left < len(ones):
                place = byte * 8 + ahead + int(ones[left])
                break
            left -= len(ones)
            byte, ahead = byte + 64, 0
        return ((place - i) << self.low_bits) | int(self._lows(i, i + 1)[0])

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        return (high | self._lows(0, self.n)).astype(np.int64)


class TokenFile:
    """A file's contents: ``ids`` of all documents and where they lie."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        magic, width, self.nulls, self.n_docs, n_ids, self.base = _HEAD.unpack_from(view, 0)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.ends, at = EliasFano.unpack(view, _HEAD.size)
        self.keys, at = EliasFano.unpack(view, at)
        self.ids = np.frombuffer(view, np.uint16 if width == 2 else np.uint32, n_ids, at)

    @staticmethod
    def pack(doc_ids: list, ids: np.ndarray, ends: np.ndarray, width: int) -> bytes:
        """``doc_ids`` ascend, nulls first."""
        nulls = sum(d is None for d in doc_ids)
        base = doc_ids[nulls] if nulls < len(doc_ids) else 0
        keys = np.array([d - base for d in doc_ids[nulls:]], np.uint64)
        head = _HEAD.pack(MAGIC, width, nulls, len(doc_ids), len(ids), base)
        body = np.ascontiguousarray(ids, np.uint16 if width == 2 else np.uint32)
        return b"".join([head, EliasFano.pack(ends), EliasFano.pack(keys), memoryview(body).cast("B")])

    def document(self, i: int) -> np.ndarray:
        """Ids of document i, found by select alone."""
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]

    def doc_ids(self) -> list:
        return [None] * self.nulls + (self.keys.all() + self.base).tolist()


def _write(folder: str, name: str, data: bytes) -> None:
    """Write a file at once: a lost or repeated task leaves a whole one."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    draft = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        out.write(data)
    store.move(draft, f"{path}/{name}")


_MADE = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("file", pa.string()), ("n_ids", pa.int64())])


def _writer(folder: str, tokenizer: str, end_id: int, file_ids: int):
    def run(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        enc = encoder(tokenizer)
        width = 2 if max(len(enc.lengths) - 1, end_id) < 1 << 16 else 4
        docs: list = []
        held: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        size = 0

        def flush():
            nonlocal docs, held, counts, size, number
            name = f"part-{part:08d}-{number:06d}.eft"
            _write(folder, name, TokenFile.pack(docs, np.concatenate(held), np.cumsum(np.concatenate(counts)), width))
            row = {"part": [part], "number": [number], "file": [name], "n_ids": [size]}
            docs, held, counts, size, number = [], [], [], 0, number + 1
            return pa.RecordBatch.from_pydict(row, _MADE)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for begin, end, texts in text_slices(batch, 2_000_000):
                ids, at = enc.encode(texts)
                n = np.diff(at) + 1
                out = np.full(len(ids) + len(n), end_id, np.uint32)
                out[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n - 1)] = ids
                docs += keys[begin:end]
                held.append(out.astype(np.uint16) if width == 2 else out)
                counts.append(n)
                size += len(out)
                if size >= file_ids:
                    yield flush()
        if docs:
            yield flush()

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, file_ids: int = 8_000_000) -> DataFrame:
    """Encode the whole texts, append ``end_id`` to each and write the ids, in
    ascending doc_id order (nulls first), to files of about ``file_ids`` ids in
    ``folder``.  Returns (part, number, file, n_ids, start): the files in
    order, and how many ids lie before each.

    A null text is empty and has the end id alone; repeated rows are written
    as often as they occur, in any order among themselves; other columns are
    ignored; an empty table writes no file."""
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    made = stage(
        ordered.mapInArrow(_writer(folder, tokenizer, end_id, file_ids), "part bigint, number bigint, file string, n_ids bigint"),
        "files",
    )
    # A row a file, not a document: few enough for one running sum.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return made.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


_READ = pa.schema([("file", pa.string()), ("doc_id", pa.int64()), ("begin", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


_READ_IDS = 500_000  # of a batch, about: 4 bytes each


def _reader(batches):
    # The worker may be one that encoded: its tokenizer and words are not needed here.
    take_over("token-files", int)
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            tokens = TokenFile(data.as_buffer())
            ends = tokens.ends.all()
            begins = np.concatenate([[0], ends[:-1]])
            keys, name = tokens.doc_ids(), path.rsplit("/", 1)[1]
            b = 0
            while b < len(keys):  # a document at least, of 500 as many as hold so many ids
                a = b
                b = min(len(keys), a + 500, max(a + 1, int(np.searchsorted(ends, begins[a] + _READ_IDS, "right"))))
                body = tokens.ids[begins[a] : ends[b - 1]].astype("<u4")
                places = (4 * (np.append(begins[a:b], ends[b - 1]) - begins[a])).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(places), pa.py_buffer(body)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * (b - a)), pa.array(keys[a:b], pa.int64()), pa.array(begins[a:b], pa.int64()),
                     pa.array(ends[a:b] - begins[a:b], pa.int64()), ids],
                    schema=_READ,
                )


def read_token_files(spark, folder: str) -> DataFrame:
    """(file, doc_id, begin, n_tokens, ids) of every document in a folder's
    files: its place in the file and its ids as little-endian 32-bit integers."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.eft").load(folder)
    return files.select("path", "content").mapInArrow(
        _reader, "file string, doc_id bigint, begin bigint, n_tokens bigint, ids binary"
    )


def token_file_report(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the files to the shared folder, read them back and return, from
    what was read, (doc_id, start, n_tokens, ids_crc32)."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "token-files")
    made = write_token_files(docs, folder, tokenizer or default_path())
    if made.isEmpty():
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    read = read_token_files(spark, folder).select("file", "doc_id", "begin", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return read.join(made.select("file", F.col("start").alias("base")), "file").select(
        "doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"
    )
