"""SimHash near-duplicates against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from shoplens.llm import simhash

SCHEMA = "doc_id bigint, text string, fp string, component string"


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + n]).encode(), seed=42).intdigest() for i in range(len(words) - n + 1)]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def _components(prints, radius):
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= radius:
                label[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(prints))]


def _texts():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    out = [None, "", " \n", "One", "one", "Two words", "two\twords", "ÀB àb", "x" * 5000, "a b c a b c a b c"]
    for _ in range(6):
        base = [rng.choice(words) for _ in range(200)]
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(200)] = rng.choice(words)
            out.append(" ".join(copy))
    return out + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(60)]


@pytest.mark.parametrize("radius", [0, 2, 5])
def test_near_duplicates(spark, radius):
    texts = _texts()
    ids = [7 * i % len(texts) for i in range(len(texts))]  # in another order
    ids[12] = None
    rows = list(zip(ids, texts, strict=True)) + [(ids[20], texts[20])] * 2 + [(None, "nothing like this at all here")]
    table = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(4)
    got = sorted(map(tuple, simhash.near_duplicates(table, radius=radius).collect()), key=repr)
    prints = [_fingerprint(t) for _, t in rows]
    group = _components(prints, radius)
    least = {}
    for g, (i, _) in zip(group, rows, strict=True):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    assert got == sorted(((i, f"{p:016x}", least[g]) for (i, _), p, g in zip(rows, prints, group, strict=True)), key=repr)


def test_tiles_of_one_cell_and_small_tiles(spark, monkeypatch):
    """Cells cut into several tiles, and tiles into several small ones."""
    monkeypatch.setattr(simhash, "TILE", 7)
    rng = random.Random(2)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for _ in range(rng.choice([0, 0, 1, 12])):
            p ^= 1 << rng.randrange(64)
            prints.add(p)
    prints = sorted(prints)
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    label = list(range(len(prints)))
    at = {p: i for i, p in enumerate(signed)}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    found = simhash.links(table, 2).collect()
    for a, b in found:
        x, y = root(at[a]), root(at[b])
        label[max(x, y)] = min(x, y)
    assert [root(i) for i in range(len(prints))] == _components(prints, 2)


@pytest.mark.parametrize("radius", [1, 3])
def test_small_tiles_skip_nothing(radius, monkeypatch):
    monkeypatch.setattr(simhash, "INNER", 8)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (40, 6), dtype=np.uint64)
    x = np.unique(np.concatenate([base, *(base ^ flips[:, k] for k in range(3))]))
    y = np.unique(np.concatenate([base ^ flips[:, 3] ^ flips[:, 4], rng.integers(0, 2**63, 30, dtype=np.uint64)]))
    both = np.concatenate([x, y])
    a, b = simhash.near_in_tiles(x, y, radius)
    want = _Sets(len(both))
    for i in range(len(x)):
        for j in range(len(x), len(both)):
            if int(both[i] ^ both[j]).bit_count() <= radius:
                want.join(i, j)
    got = _Sets(len(both))
    for p, q in zip(a, b, strict=True):  # x and y may share values: join equal ones in both
        got.join(int(np.flatnonzero(both == p)[0]), int(np.flatnonzero(both == q)[0]))
    for s in (want, got):
        for i in range(len(both)):
            s.join(i, int(np.flatnonzero(both == both[i])[0]))
    assert want.roots() == got.roots()
    assert len(a) < len(both)


class _Sets:
    def __init__(self, n):
        self.up = list(range(n))

    def root(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, i, j):
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)

    def roots(self):
        return [self.root(i) for i in range(len(self.up))]


def test_empty_table_and_radius(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    with pytest.raises(ValueError):
        simhash.near_duplicates(empty, radius=9)


def test_steps_reach_every_cell_within_the_radius():
    steps = simhash.cell_steps(2)
    assert len(steps) == 21 and steps[0] == 0  # 41 vectors, one of each pair of opposites
