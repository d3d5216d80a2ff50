"""Alignment of two tokenizers against whole texts encoded one by one."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shoplens.llm import alignment
from shoplens.llm.tokens import byte_letters

SCHEMA = "doc_id bigint, text string, n_a string, digest int"


def _texts():
    rng = random.Random(8)
    words = ["the", "of", "a", "isn't", "Zürich", "漢字", "foo_bar", "1234567", "x.y", " ", "ﬁ", "é", "<s>", "<|endoftext|>", "🙂"]
    words += ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 12))) for _ in range(80)]
    gaps = [" "] * 12 + ["  ", "   ", "\n", " \n", "\t", "\n\n ", "\r\n", " ", " \x1c", "\x00"]
    out = [None, "", " ", "  ", "a", " a", "a ", "a  ", "  a", "\n", "▁", "a ▁ b", "a▁b c", "<unk>", "<0x41>", "x" * 3000, "a" + " " * 50 + "b"]
    for _ in range(120):
        text = ""
        for _ in range(rng.randint(1, 60)):
            text += rng.choice(words) + rng.choice(gaps)
        out.append(text)
    return out


def _wanted(texts):
    a_file = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_file.encode_special_tokens = True
    b_file = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = byte_letters()

    def b_bytes(piece):
        return bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()

    each, pairs = [], Counter()
    for text in texts:
        if not text:
            each.append(None)
            continue
        a = a_file.encode(" " + text, add_special_tokens=False).ids
        b = b_file.encode(text)
        a_parts = [bytes(letters[c] for c in a_file.id_to_token(i)) for i in a]
        b_parts = [b_bytes(b_file.id_to_piece(i)) for i in b]
        if not b"".join(a_parts) == b"".join(b_parts) == (" " + text).encode():
            each.append(None)
            continue
        a_end = dict(zip(np.cumsum([len(p) for p in a_parts]).tolist(), range(len(a)), strict=True))
        b_end = dict(zip(np.cumsum([len(p) for p in b_parts]).tolist(), range(len(b)), strict=True))
        groups, links, x, y = [], [], 0, 0
        for end in sorted(set(a_end) & set(b_end)):
            i, j = a_end[end] + 1, b_end[end] + 1
            groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
            links.append((b[j - 1], a[i - 1]))
            x, y = i, j
        pairs.update(links)
        each.append((len(a), len(b), links, ";".join(groups)))
    most = defaultdict(int)
    for (b, _), n in pairs.items():
        most[b] = max(most[b], n)
    out = []
    for one in each:
        if one is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, groups = one
        best = sum(pairs[p] == most[p[0]] for p in links)
        out.append((n_a, n_b, len(links), len(links), best, sum(pairs[p] for p in links), hashlib.sha256(groups.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("settings", [{}, {"RECORDS": 300, "BLOCK": 5, "LEAST_BUCKETS": 3}])
def test_align(spark, settings, monkeypatch):
    """Also with many small runs and blocks."""
    for name, value in settings.items():
        monkeypatch.setattr(alignment, name, value)
    texts = _texts()
    rows = [(None if i % 17 == 3 else i, t) for i, t in enumerate(texts)]
    rows += rows[20:24]  # repeated rows
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    got = sorted(map(tuple, alignment.align(table, buckets=3 if settings else None).collect()), key=repr)
    want = [(i, *w) for (i, _), w in zip(rows, _wanted([t for _, t in rows]), strict=True)]
    assert got == sorted(want, key=repr)
    assert sum(w[1] > 0 for w in want) > 100


def test_merge_of_many_runs():
    """Blocks of runs that overlap, one B id in most of them, closed early."""
    rng = random.Random(6)
    runs = {}
    for run in range(40):
        pairs = {(rng.choice([5, 5, 5, rng.randrange(50)]), rng.randrange(30)): rng.randint(1, 9) for _ in range(60)}
        runs[run] = sorted(pairs.items())
    totals, most = Counter(), defaultdict(int)
    for pairs in runs.values():
        for p, n in pairs:
            totals[p] += n
    for (b, _), n in totals.items():
        most[b] = max(most[b], n)
    blocks = []
    for run, pairs in runs.items():
        for k in range(0, len(pairs), 7):
            keys = np.array([b << alignment._ID | a for (b, a), _ in pairs[k : k + 7]], np.uint64)
            times = np.array([n for _, n in pairs[k : k + 7]], np.uint64)
            heads = alignment.pack(np.diff(keys, prepend=np.uint64(0)))
            blocks.append((int(keys[0]), alignment._Block(run, 0, int(keys[0]), heads, alignment.pack(times))))
    blocks.sort(key=lambda b: b[0])
    merge, answers = alignment._Merge(50), []
    largest = 0
    for first, block in blocks:
        if merge.due(first >> alignment._ID << alignment._ID):
            answers += merge.close(first >> alignment._ID << alignment._ID)
        merge.push(block)
        largest = max(largest, merge.pending)
    answers += merge.close(1 << 62)
    assert largest < sum(len(b.keys) for _, b in blocks)
    got = defaultdict(list)
    for row in sorted(answers, key=lambda r: (r["run"], r["first"])):
        got[row["run"]] += alignment.unpack(row["answers"], np.uint64).tolist()
    assert got == {run: [totals[p] << 1 | (totals[p] == most[p[0]]) for p, _ in pairs] for run, pairs in runs.items()}


def test_empty_table_and_other_files(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment.align(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None, None), (None, "", None, None)], SCHEMA)
    assert sorted(map(tuple, alignment.align(blank).collect()), key=repr) == sorted(
        [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")], key=repr
    )


def test_pack_round_trip():
    for dtype in (np.uint32, np.uint64):
        for n in (0, 1, 1000):
            values = np.random.default_rng(n).integers(0, 2**31, n).astype(dtype)
            assert (alignment.unpack(alignment.pack(values), dtype) == values).all()


def test_words_are_forgotten_between_slices(monkeypatch):
    monkeypatch.setattr(alignment, "WORDS", 30)
    texts = [t or "" for t in _texts()]
    aligner = alignment.Aligner(public_tokenizers.path("byte_bpe_50k.json"), alignment.piece_path())
    run = alignment._Run(10**9, 100)
    for k in range(0, len(texts), 9):
        run.take(list(range(k, k + 9))[: len(texts) - k], texts[k : k + 9], aligner)
    want = _wanted(texts)
    assert list(zip(run.n_a, run.n_b, run.n_links, run.digest, strict=True)) == [(w[0], w[1], w[2], w[6]) for w in want]
    assert all(len(w) <= alignment.LONGEST for w in aligner.number)
