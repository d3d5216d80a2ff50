"""Token counts by section (operator 9).

A document is encoded once, whole.  The tokens' byte spans follow from the
tokens' lengths, and an interval join (both sides are in order, so a binary
search of each boundary) attributes them to sections.  A token that crosses a
boundary is allocated by the ``rule``:

* ``start``: to the section that holds its first byte;
* ``most``: to the section that holds most of its bytes, the earlier of equals.

Bytes outside all sections count for section -1."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .tokens import default_path, encoder

_OUT = pa.schema([("doc_id", pa.int64()), ("section", pa.int64()), ("first_char", pa.int64()), ("end_char", pa.int64()), ("n_tokens", pa.int64()), ("n_crossing", pa.int64())])
_OUT_SQL = "doc_id bigint, section bigint, first_char bigint, end_char bigint, n_tokens bigint, n_crossing bigint"


def lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sections of a text without given ones: its lines, with their ends."""
    ends = [i + 1 for i, c in enumerate(text) if c == "\n"] if "\n" in text else []
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return np.array([0, *ends[:-1]], np.int64), np.array(ends, np.int64)


def char_bytes(text: str) -> np.ndarray:
    """Byte offset of every character, and of the end."""
    data = np.frombuffer(text.encode(), np.uint8)
    return np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))


def attribute(lengths: np.ndarray, first: np.ndarray, end: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Tokens of each byte range (in order, not overlapping), those of them
    that cross a range's boundary, and the tokens of no range."""
    stops = np.cumsum(lengths)
    starts = stops - lengths
    bounds = np.stack([first, end], 1).ravel()
    inside = np.searchsorted(bounds, starts, side="right")  # odd: in range (inside - 1) / 2
    # empty ranges hold no byte; side="right" steps over them
    last = np.searchsorted(bounds, stops - 1, side="right")
    owner = np.where(inside % 2 == 1, inside // 2, -1)
    crossing = inside != last
    if rule == "most":
        for t in np.flatnonzero(crossing):
            near = range(max(0, (inside[t] - 1) // 2), min(len(first), last[t] // 2 + 1))
            shares = [(min(end[s], stops[t]) - max(first[s], starts[t]), -s) for s in near]
            best = max(shares, default=(0, 0))
            owner[t] = -best[1] if best[0] > 0 else -1
    elif rule != "start":
        raise ValueError(rule)
    held = owner >= 0
    return (
        np.bincount(owner[held], minlength=len(first)),
        np.bincount(owner[held & crossing], minlength=len(first)),
        int((~held).sum()),
    )


def _rows(tokenizer: str, rule: str, given: bool):
    def run(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            sections = batch.column(2).to_pylist() if given else [None] * len(texts)
            for begin, stop in slices(batch, texts, 2_000_000):
                ids, at = enc.encode(texts[begin:stop])
                sizes = enc.lengths[ids]
                cols: list[list] = [[] for _ in _OUT]
                for i in range(begin, stop):
                    text = texts[i]
                    if given:
                        rows = sorted((s["first_char"], s["end_char"], s["section"]) for s in sections[i] or [])
                        first, end = (np.array([r[k] for r in rows], np.int64) for k in (0, 1))
                        names = [r[2] for r in rows]
                        if (end < first).any() or (first[1:] < end[:-1]).any():
                            raise ValueError(f"sections of document {docs[i]} overlap or end before they begin")
                    else:
                        first, end = lines(text)
                        names = list(range(len(first)))
                    places = char_bytes(text)
                    first, end = np.clip(first, 0, len(text)), np.clip(end, 0, len(text))
                    n, crossing, loose = attribute(
                        sizes[at[i - begin] : at[i - begin + 1]], places[first], places[end], rule
                    )
                    if loose:
                        names, first, end = [*names, -1], np.append(first, 0), np.append(end, len(text))
                        n, crossing = np.append(n, loose), np.append(crossing, 0)
                    for col, x in zip(cols, ([docs[i]] * len(names), names, first.tolist(), end.tolist(), n.tolist(), crossing.tolist()), strict=True):
                        col += x
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _OUT, strict=True)], schema=_OUT)

    return run


def token_counts(docs: DataFrame, sections: DataFrame | None = None, rule: str = "start", tokenizer: str | None = None) -> DataFrame:
    """(doc_id, section, first_char, end_char, n_tokens, n_crossing) for every
    section of every row of ``docs``.

    ``sections`` has (doc_id, section, first_char, end_char) in code points; ones
    of a document that overlap or end before they begin are refused (the job
    fails), ones past the text's end are cut there.  Without it the sections are
    the lines.
    A document's counts add up to its tokens.  A null text is empty: one empty
    line without tokens.  Repeated rows each give their rows; a null doc_id
    has no given sections; other columns are ignored; an empty table gives an
    empty result."""
    tokenizer = tokenizer or default_path()
    docs = docs.select("doc_id", "text")
    if sections is not None:
        own = sections.groupBy("doc_id").agg(F.collect_list(F.struct("section", "first_char", "end_char")).alias("of"))
        docs = docs.join(own, "doc_id", "left")
    return docs.mapInArrow(_rows(tokenizer, rule, sections is not None), _OUT_SQL)
