"""BPE encoding and decoding with tree concatenation (operator 7).

Long texts are cut into leaves of equal length, anywhere, and the leaves are
encoded in parallel.  A tree of joins puts the ids together: around each join
a window of text is encoded anew, and it grows until both sides agree with it:

* where the window's edge can be put at a place at which the tokenizer's
  pattern must start a new piece (a letter after a digit, a space before a
  word, ...), the ids on either side of the edge are independent;
* within text that the pattern never splits, the edge is at a token boundary,
  and the window's outer two tokens must equal those already there.  Byte-pair
  encoding is decided by neighbours: a sequence is the encoding if each two
  neighbours encode to themselves, which holds inside both halves and inside
  the window.

A window that reaches both ends is the whole text, so the result is exact in
any case."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import over_texts
from .tokens import Encoder, default_path, encoder

LONG, LEAF = 16_384, 8_192
#: Places where a new piece starts whatever else the text holds.
_PIECE = regex.compile(
    r"(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])|(?<=[^\s\p{L}\p{N}])(?=\p{N})|(?<=\S)(?= \S)"
)


def _inside(text: str, at: int, special: list[str]) -> bool:
    """Whether ``at`` lies inside a special token's text."""
    for token in special:
        n = len(token) - 1
        if token in text[max(0, at - n) : at + n]:
            return True
    return False


def _back(text: str, ids: np.ndarray, lengths: np.ndarray, at: int) -> int | None:
    """How many of the last ids cover text[at:], if some exactly do."""
    need = len(text[at:].encode())
    sums = np.cumsum(lengths[ids[::-1][: need + 1]])
    k = int(np.searchsorted(sums, need))
    return k + 1 if k < len(sums) and sums[k] == need else (0 if need == 0 else None)


def _front(text: str, ids: np.ndarray, lengths: np.ndarray, at: int) -> int | None:
    """How many of the first ids cover text[:at], if some exactly do."""
    need = len(text[:at].encode())
    sums = np.cumsum(lengths[ids[: need + 1]])
    k = int(np.searchsorted(sums, need))
    return k + 1 if k < len(sums) and sums[k] == need else (0 if need == 0 else None)


def _edges(left: str, right: str, left_ids, right_ids, lengths, special, reach: int):
    """A window: (left cut, right cut, last ids of the left half in it, first
    ids of the right half in it, sure on the left, sure on the right)."""
    lo, hi = max(0, len(left) - reach), min(len(right), reach)
    a, b, sure_a, sure_b = lo, hi, lo == 0, hi == len(right)
    if not sure_a:
        for m in _PIECE.finditer(left, lo, len(left) - 16):
            if not _inside(left, m.start(), special):
                a, sure_a = m.start(), True
                break
    if not sure_b:
        for m in _PIECE.finditer(right, 16, hi):
            if not _inside(right, m.start(), special):
                b, sure_b = m.start(), True
    back = _back(left, left_ids, lengths, a)
    while back is None and not sure_a and a < len(left) - 8:
        a += 1
        back = _back(left, left_ids, lengths, a)
    front = _front(right, right_ids, lengths, b)
    while front is None and not sure_b and b > 8:
        b -= 1
        front = _front(right, right_ids, lengths, b)
    return a, b, back, front, sure_a, sure_b


def _agree(ids, old, sure: bool, text: str, at: int, special, outer: slice) -> bool:
    if sure:
        return True
    if text[max(0, at - 1) : at + 1].strip() != text[max(0, at - 1) : at + 1] or _inside(text, at, special):
        return False
    return len(ids) >= 4 and len(old) >= 2 and np.array_equal(ids[outer], old[outer])


def join(enc: Encoder, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray) -> np.ndarray:
    """Ids of left + right from those of the halves."""
    if not left or not right:
        return left_ids if left else right_ids
    reach = 64
    while True:
        a, b, back, front, sure_a, sure_b = _edges(left, right, left_ids, right_ids, enc.lengths, enc.special, reach)
        if back is not None and front is not None:
            window = np.array(enc.plain([left[a:] + right[:b]])[0], np.uint32)
            old_left, old_right = left_ids[len(left_ids) - back :], right_ids[:front]
            if _agree(window, old_left, sure_a, left, a, enc.special, slice(0, 2)) and _agree(
                window, old_right, sure_b, right, b, enc.special, slice(-2, None)
            ):
                return np.concatenate([left_ids[: len(left_ids) - back], window, right_ids[front:]])
        if reach >= max(len(left), len(right)):
            return np.array(enc.plain([left + right])[0], np.uint32)
        reach *= 4


def join_all(enc: Encoder, texts: list[str], ids: list[np.ndarray]) -> np.ndarray:
    """The tree of joins over neighbouring leaves."""
    while len(texts) > 1:
        pairs = range(0, len(texts) - 1, 2)
        tail = len(texts) - len(texts) % 2
        ids = [join(enc, texts[i], ids[i], texts[i + 1], ids[i + 1]) for i in pairs] + ids[tail:]
        texts = [texts[i] + texts[i + 1] for i in pairs] + texts[tail:]
    return ids[0] if ids else np.zeros(0, np.uint32)


def leaves(text: str, size: int, special: list[str]) -> list[str]:
    """Cut at every ``size`` characters, but not inside a special token."""
    cuts = []
    for at in range(size, len(text), size):
        while at > 0 and _inside(text, at, special):
            at -= 1
        cuts.append(at)
    bounds = sorted({0, *cuts, len(text)})
    return [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def encode_tree(enc: Encoder, text: str, leaf: int = LEAF) -> np.ndarray:
    """The whole method on one machine, for tests and small callers."""
    parts = leaves(text, leaf, enc.special)
    ids, at = enc.encode(parts)
    return join_all(enc, parts, [ids[a:b] for a, b in zip(at, at[1:], strict=False)])


_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])
_OUT_SQL = "doc_id bigint, n_tokens bigint, ids binary, decoded string"


def _row(enc: Encoder, ids: np.ndarray) -> tuple[int, bytes, str]:
    return len(ids), ids.astype("<u4").tobytes(), enc.decode(ids).decode("utf-8", "replace")


def _short(tokenizer: str):
    def rows(docs: list, texts: list[str]) -> dict[str, list]:
        enc = encoder(tokenizer)
        ids, at = enc.encode(texts)
        done = [_row(enc, ids[a:b]) for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]
        n, data, text = zip(*done, strict=True)
        return {"doc_id": docs, "n_tokens": n, "ids": data, "decoded": text}

    return rows


def _leaf_rows(tokenizer: str, size: int):
    def run(batches):
        special = encoder(tokenizer).special
        for batch in batches:
            for row, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = leaves(text, size, special)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(parts), pa.int64()), pa.array([doc] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int64()), pa.array(parts, pa.string())],
                    ["row", "doc_id", "leaf", "text"],
                )

    return run


def _encode_leaves(tokenizer: str):
    def run(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            for begin in range(0, batch.num_rows, 200):
                part = batch.slice(begin, 200)
                ids, at = enc.encode(part.column(3).to_pylist())
                data = [ids[a:b].tobytes() for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], ["row", "doc_id", "leaf", "text", "ids"])

    return run


def _join_leaves(tokenizer: str):
    def run(table: pa.Table) -> pa.Table:
        enc = encoder(tokenizer)
        table = table.sort_by("leaf")
        ids = [np.frombuffer(x, np.uint32) for x in table["ids"].to_pylist()]
        n, data, text = _row(enc, join_all(enc, table["text"].to_pylist(), ids))
        return pa.table({"doc_id": [table["doc_id"][0].as_py()], "n_tokens": [n], "ids": [data], "decoded": [text]}, schema=_OUT)

    return run


def encode_documents(docs: DataFrame, tokenizer: str | None = None, long: int = LONG, leaf: int = LEAF) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row: the ids of the whole text
    as little-endian 32-bit integers and the text decoded from them, special
    tokens included.

    Texts of more than ``long`` characters are encoded by leaves of ``leaf``
    characters dealt out over the cluster; a group gathers the leaves of one
    text.  A null text is empty (no ids); repeated rows each give a row; other
    columns are ignored; an empty table gives an empty result."""
    tokenizer = tokenizer or default_path()
    docs = docs.select("doc_id", "text")
    is_long = F.coalesce(F.length("text") > long, F.lit(False))
    short = docs.filter(~is_long).mapInArrow(over_texts(_short(tokenizer), _OUT, 2_000_000), _OUT_SQL)
    cut = (
        docs.filter(is_long)
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        .mapInArrow(_leaf_rows(tokenizer, leaf), "row bigint, doc_id bigint, leaf bigint, text string")
        .repartition("row", "leaf")
        .mapInArrow(_encode_leaves(tokenizer), "row bigint, doc_id bigint, leaf bigint, text string, ids binary")
    )
    joined = cut.groupBy("row").applyInArrow(_join_leaves(tokenizer), _OUT_SQL)
    return short.unionAll(joined)
