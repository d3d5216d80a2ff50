"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from shoplens.llm import conversations as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string, copies string, kind int"


def _damaged(rows):
    out = []
    for c, t, r, x in rows:
        r, x = (" " if r is None else r), (" " if x is None else x)
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fault == 0:
            continue
        x = "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x
        out += [(c, t, "user" if fault == 4 else r, x)] * (2 if fault == 3 else 1)
    return out


def _wanted(rows):
    """By Dijkstra over (row, state, letters) in order of cost, then letters."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    ok = re.compile(r"(s?(ua)+)?")
    # a partial answer is a prefix of s?(ua)+
    prefix = re.compile(r"s?(ua)*u?")
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, shape, out = heapq.heappop(heap)
        if i == len(rows) and ok.fullmatch(shape):
            break
        mark = (i, shape[-1:] if shape != "s" else "S")
        if mark in done:
            continue
        done.add(mark)

        def push(more, letter, j, initial, row, cost=cost, audit=audit, shape=shape, out=out):
            if initial is None or prefix.fullmatch(shape + initial):
                heapq.heappush(heap, (cost + more, audit + letter, j, shape + (initial or ""), out + ((row,) if row else ())))

        for initial, name in (("u", "user"), ("a", "assistant")):
            push(5, "I", i, initial, name + ":")
        if i < len(rows):
            _, _, role, text = rows[i]
            push(2, "D", i + 1, None, None)
            if faults[i] not in ("b", "d"):
                extra = 5 if faults[i] == "t" else 0
                if role[:1] in ("s", "u", "a"):
                    push(extra, "K", i + 1, role[:1], f"{role}:{text}")
                for initial, name in (("u", "user"), ("a", "assistant")):
                    push(extra + 1, "R", i + 1, initial, f"{name}:{text}")
    n = {k: faults.count(k) for k in "bdt"}
    return gaps, n["b"], n["d"], n["t"], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(), out


def _rows():
    rng = random.Random(3)
    texts = ["a.", "b!", "no end", "", " \t", "c?\n", "long " * 50 + ".", None, "é\x85", "x.\x85"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown", "System"]
    rows = []
    for c in [None, *range(-1, 220)]:
        n = rng.choice([1, 2, 3, 5, 8, 30])
        for t in range(n):
            turn = rng.choice([t, t, t, t, t, None, rng.randrange(8), t + 3])
            odd = rng.random() < 0.4
            role = rng.choice(roles) if odd else ("user", "assistant")[t % 2]
            text = rng.choice(texts) if odd else f"answer {rng.randrange(10**6)}{rng.choice('.!? ')}"
            rows.append((c, turn, role, text))
    return rows + rows[5:9]  # repeated rows


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("chunk", [C.CHUNK_ROWS, 3])
def test_report_against_search(table, rows, chunk, monkeypatch):
    monkeypatch.setattr(C, "CHUNK_ROWS", chunk)
    got = {r.conv_id: tuple(r)[1:] for r in C.repair_report(table, C.damage(table)).collect()}
    want = {c: _wanted([r for r in _damaged(rows) if r[0] == c])[:8] for c in {r[0] for r in rows}}
    assert got == want


def test_repaired_rows(table, rows):
    got = {}
    for r in sorted(C.repair(table).collect(), key=lambda r: r.position):
        got.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    whole = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for c in {r[0] for r in rows}:
        assert tuple(got.get(c, [])) == _wanted([r for r in whole if r[0] == c])[8]


def test_long_conversation_and_many_copies(spark):
    """A conversation over many chunks and partitions, one row of it a
    thousand times, and a text that every second turn repeats."""
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["same.", f"turn {t}.", f"cut {t}"])) for t in range(700)]
    rows += [(1, 350, "user", "again and again.")] * 1000 + [(2, 0, "user", "hi.")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: tuple(r)[1:] for r in C.repair_report(table).collect()}
    assert got == {c: _wanted([r for r in rows if r[0] == c])[:8] for c in (1, 2)}


def test_empty_table_and_nothing_left(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.repair_report(empty).count() == 0
    assert C.repair(empty).count() == 0
    dropped = next(c for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(dropped, 0, "user", "hi.", None, None), (None, None, None, None, None, None)], SCHEMA)
    got = {r.conv_id: tuple(r)[1:] for r in C.repair_report(one, C.damage(one)).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", nothing)
    assert got[None] == _wanted(_damaged([(None, None, None, None)]))[:8]


def test_every_block_is_composed_of_single_steps():
    vectors, single, block = C.tables()
    assert len(vectors) < 200
    rng = random.Random(1)
    for _ in range(500):
        v, symbols = rng.randrange(len(vectors)), [rng.randrange(C.SYMBOLS) for _ in range(C.BLOCK)]
        at = v
        for s in reversed(symbols):
            at = int(single[at, s])
        assert block[v, int("".join(map(str, symbols)))] == at
