"""The training-data operators against brute force, on a small table with
nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from shoplens.llm import bpe, decontamination, license_scan, near_dedup, pii, queries, repeats, token_counts, token_files, tokens, topk, toxicity

SCHEMA = "doc_id bigint, text string, spans string, kept string, _1 int"
OPERATORS = {
    "near": near_dedup.near_duplicates,
    "files": token_files.token_file_report,
    "license": license_scan.license_report,
    "bpe": bpe.encode_documents,
    "pii": pii.pii_report,
    "counts": token_counts.token_counts,
    "repeats": repeats.removal_report,
}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, passage = prose(120).split(), prose(90)
    out = [(0, None), (1, ""), (2, " \n "), (3, "one two"), (4, "One TWO")]
    for i in range(5, 25):  # near copies of one text
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        out.append((i, " ".join(copy)))
    out += [(i, prose(150)) for i in range(25, 40)]
    out += [(i, prose(30) + " " + passage + " " + prose(30)) for i in range(40, 46)]
    out += [(46, out[30][1]), (47, prose(4000)), (48, "x" * 9000), (49, "漢字 é " * 300)]
    out += [(50, "mail a.b@c.example.org or 10.0.0.1, call +1 (555) 010-9999. Card 4111 1111 1111 1111; 256.1.1.1")]
    out += [(51, "Released under the MIT License.\nGNU general public license, CC-BY 4.0"), (52, "<|endoftext|> a  b\n\n c")]
    return out + [out[7], out[7]]  # repeated rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "clash", "clash", 1) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_and_null_rows(spark, name):
    empty = spark.createDataFrame([], SCHEMA)
    assert OPERATORS[name](empty).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None), (None, "a b c", None, None, None), (7, "", None, None, None)], SCHEMA)
    assert OPERATORS[name](nulls).count() >= 3


def test_near_duplicates(docs, texts):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    name = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                    name[a] = name[b] = min(name[a], name[b])
    assert got == {(i, len(sets[i]), name[i], name[i] == i) for i in sets}


def test_near_duplicates_of_alike_families(spark):
    """Families whose members are mostly alike below the threshold, of unlike
    lengths, with links between members that their centre is not alike to."""
    rng = random.Random(11)
    texts = []
    for _ in range(3):
        base = [f"w{rng.randrange(10**6)}" for _ in range(110)]
        for _ in range(45):
            copy = list(base)
            for _ in range(rng.randint(3, 9)):
                copy[rng.randrange(len(copy))] = f"v{rng.randrange(10**6)}"
            copy = copy[rng.randint(0, 12) : len(copy) - rng.randint(0, 12)]
            texts.append(" ".join(copy))
            if rng.random() < 0.3:  # a near copy of this variant
                copy[rng.randrange(len(copy))] = "z"
                texts.append(" ".join(copy))
    rng.shuffle(texts)
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in texts]
    name = list(range(len(sets)))
    links = [(a, b) for a in name for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            name[a] = name[b] = min(name[a], name[b])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    # without draws, so that the join outside the centres has to find the rest
    for turns in (0, near_dedup.TURNS):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(near_dedup, "TURNS", turns)
            got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
        assert got == dict(enumerate(name))


@pytest.mark.parametrize("percent", [30, 50])
def test_near_duplicates_at_a_lower_percent(spark, percent):
    rng = random.Random(percent)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(8))
    rows, want = [], {}
    for k in range(60):  # pairs that share the first c of 200 words: just alike, or just not
        c = 2 * 200 * percent // (100 + percent) + (2 if k % 2 else -2)
        first = [word() for _ in range(200)]
        rows += [(2 * k, " ".join(first)), (2 * k + 1, " ".join(first[:c] + [word() for _ in range(200 - c)]))]
        a, b = ({tuple(t.split()[i : i + 1]) for i in range(200)} for _, t in rows[-2:])
        alike = 100 * len(a & b) >= percent * len(a | b)
        assert alike == bool(k % 2)
        want |= {2 * k: 2 * k, 2 * k + 1: 2 * k + 1 - alike}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, width=1, percent=percent).collect()}
    assert got == want


def test_layout_of_bands():
    assert near_dedup.layout(75) == near_dedup.layout(100) == (40, 4, 93) and near_dedup.least_equal(0.75, 160) == 93
    for percent in range(1, 76):
        bands, rows, least = near_dedup.layout(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= 2.6e-7 and 0 <= least < bands * rows
    with pytest.raises(ValueError):
        near_dedup.layout(0)


def test_sketch_fills_every_bin():
    for n in (1, 2, 7, 500):
        values = near_dedup.mix(np.arange(1, n + 1, dtype=np.uint64))
        assert (near_dedup.sketch(values) < np.iinfo(np.uint64).max).all()
    a, b = (near_dedup.mix(np.arange(x, x + 400, dtype=np.uint64)) for x in (0, 100))
    same = (near_dedup.sketch(a) == near_dedup.sketch(b)).mean()
    assert abs(same - 0.6) < 0.15


@pytest.mark.parametrize("group", [2, 256])
def test_repeated_strings(docs, texts, group):
    depth = 400
    data = [(i, (t or "").encode()) for i, t in texts]
    count = defaultdict(int)
    for _, x in data:
        for k in range(len(x) - depth + 1):
            count[x[k : k + depth]] += 1
    want = []
    for i, x in data:
        gone = np.zeros(len(x) + 1, bool)
        for k in range(len(x) - depth + 1):
            if count[x[k : k + depth]] > 1:
                gone[k : k + depth] = True
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want.append((i, len(x), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in repeats.removal_report(docs, group=group).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("group", [2, 256])
def test_repeated_strings_of_unlike_texts_with_one_id(spark, group):
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passages = [noise(450) for _ in range(4)]
    rows = [(None, noise(100 + 170 * k) + passages[k] + noise(300)) for k in range(4)]
    rows += [(1, noise(1500 - 300 * k) + passages[k] + noise(20)) for k in range(4)]
    rows += [(2, noise(900)), (2, rows[0][1][:520]), (None, noise(410)), (None, rows[1][1]), (3, rows[6][1]), (None, None), (2, "short")]
    data = [(t or "").encode() for _, t in rows]
    places = defaultdict(set)
    for k, d in enumerate(data):
        for a in range(len(d) - 399):
            places[d[a : a + 400]].add((k, a))
    want = []
    for k, ((i, _), d) in enumerate(zip(rows, data)):
        gone, n, last = set(), 0, -1
        for a in range(len(d) - 399):
            if len(places[d[a : a + 400]]) > 1:
                n += a > last
                last = a + 400
                gone.update(range(a, a + 400))
        kept = bytes(b for j, b in enumerate(d) if j not in gone)
        want.append((i, len(d), len(gone), n, hashlib.sha256(kept).hexdigest()))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = [tuple(r) for r in repeats.removal_report(docs, group=group).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def _ids(text):
    return tokens.encoder(tokens.default_path()).plain([text or ""])[0]


def test_token_files(docs, texts):
    want, start = {}, 0
    for i, t in sorted(texts, key=lambda r: r[0]):
        ids = np.array([*_ids(t), 2], "<u4")
        want.setdefault(i, []).append((start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = defaultdict(list)
    for r in token_files.token_file_report(docs).collect():
        got[r.doc_id].append((r.start, r.n_tokens, r.ids_crc32))
    assert {i: sorted(x) for i, x in got.items()} == want


def test_reading_token_files_follows_their_ids(monkeypatch):
    ends = np.cumsum([700, 10, 10, 0, 900, 5])
    data = token_files.TokenFile.pack([None, 1, 2, 3, 4, 9], np.arange(ends[-1]) % 7, ends, 2)
    files = pa.RecordBatch.from_pydict({"path": ["file:/a/part-0.eft"], "content": [data]})
    tokens.encoder(tokens.default_path())
    monkeypatch.setattr(token_files, "_READ_IDS", 720)
    read = list(token_files._reader(iter([files])))
    assert tokens._encoder.cache_info().currsize == 0  # what writing left in the worker is gone
    assert [b.column(1).to_pylist() for b in read] == [[None, 1, 2, 3], [4], [9]]
    assert [n for b in read for n in b.column(3).to_pylist()] == [700, 10, 10, 0, 900, 5]
    assert b"".join(i for b in read for i in b.column(4).to_pylist()) == (np.arange(ends[-1]) % 7).astype("<u4").tobytes()


def test_elias_fano_select():
    for values in ([], [0], [5, 5, 5], list(range(0, 90_000, 7)), [0, 10**6]):
        seq, _ = token_files.EliasFano.unpack(memoryview(token_files.EliasFano.pack(np.array(values, np.int64))), 0)
        assert seq.all().tolist() == values and [seq.select(i) for i in range(len(values))] == values


def test_bpe_round_trip(docs, texts):
    got = sorted((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in bpe.encode_documents(docs, long=2000, leaf=700).collect())
    want = sorted((i, len(_ids(t)), np.array(_ids(t), "<u4").tobytes(), t or "") for i, t in texts)
    assert got == want


def test_tree_joins_are_exact_anywhere():
    enc, rng = tokens.encoder(tokens.default_path()), random.Random(1)
    alphabet = ["a", "b", "'", "s", " ", "\n", "1", "é", "漢", "!", "<|endoftext|>", "the", " ing", "re", "\t", "🙂"]
    cases = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 900))) for _ in range(25)]
    cases += ["a" * 3000, " " * 900 + "x" + "\n" * 800, "".join(rng.choice("abcdef") for _ in range(3000))]
    for text in cases:
        for leaf in (29, 400):
            assert bpe.encode_tree(enc, text, leaf).tolist() == enc.plain([text])[0]


def test_token_counts(docs, texts):
    got = defaultdict(int)
    for r in token_counts.token_counts(docs).collect():
        got[r.doc_id] += r.n_tokens
    want = defaultdict(int)
    for i, t in texts:
        want[i] += len(_ids(t))
    assert got == want
    n, crossing, loose = token_counts.attribute(np.array([3, 4, 2]), np.array([0, 5]), np.array([5, 9]), "start")
    assert (n.tolist(), crossing.tolist(), loose) == ([2, 1], [1, 0], 0)
    n, _, _ = token_counts.attribute(np.array([3, 4, 2]), np.array([0, 4]), np.array([4, 9]), "most")
    assert n.tolist() == [1, 2]


def _attributed(text, sections, rule):
    """(section, tokens, crossing ones), token by token; ``sections`` by place."""
    enc = tokens.encoder(tokens.default_path())
    at = [len(text[:k].encode()) for k in range(len(text) + 1)]
    ranges = {name: (at[min(a, len(text))], at[min(b, len(text))]) for name, a, b in sections}
    count, cross, begin = defaultdict(int), defaultdict(int), 0
    for i in _ids(text):
        end = begin + int(enc.lengths[i])
        inside = lambda p: next((n for n, (a, b) in ranges.items() if a <= p < b), -1)
        owner = inside(begin)
        crossing = any(begin < edge < end for a, b in ranges.values() if a < b for edge in (a, b))
        if rule == "most" and crossing:
            share = {n: min(b, end) - max(a, begin) for n, (a, b) in ranges.items()}
            best = max(share.values(), default=0)
            owner = next((n for n, x in share.items() if x == best), -1) if best > 0 else -1
        count[owner] += 1
        cross[owner] += crossing and owner != -1
        begin = end
    return {n: (count[n], cross[n]) for n in {*ranges, *([-1] if count[-1] else [])}}


@pytest.mark.parametrize("rule", ["start", "most"])
def test_token_counts_of_sections(spark, rule):
    rng = random.Random(15)
    texts = ["hello big world", "Zürich über alles\n漢字 é\n\nend", "a  b\n", "", "x" * 50, "unbelievably uncomfortable circumstances"]
    texts += ["".join(rng.choice(["word", "é", " ", "\n", "12", "漢", ","]) for _ in range(60)) for _ in range(25)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, section string")
    rows, want = [], {}
    for i, t in enumerate(texts):
        edges = sorted(rng.randrange(len(t) + 4) for _ in range(2 * rng.randint(0, 4)))
        own = [(10 * i + k, a, b) for k, (a, b) in enumerate(zip(edges[::2], edges[1::2]))]
        rows += [(i, *o, 0) for o in own]
        want[i] = _attributed(t, own, rule)
    sections = spark.createDataFrame(rows, "doc_id bigint, section bigint, first_char bigint, end_char bigint, text int")
    got = {i: {} for i in want}
    for r in token_counts.token_counts(docs, sections, rule).collect():
        got[r.doc_id][r.section] = (r.n_tokens, r.n_crossing)
    assert got == want
    by_line = {i: {} for i in want}
    for r in token_counts.token_counts(docs, rule=rule).collect():
        by_line[r.doc_id][r.section] = (r.n_tokens, r.n_crossing)
    for i, t in enumerate(texts):
        first, end = token_counts.lines(t)
        assert by_line[i] == _attributed(t, list(zip(range(len(first)), first.tolist(), end.tolist())), rule)


def test_overlapping_sections_are_refused(spark):
    docs = spark.createDataFrame([(1, "hello big world")], "doc_id bigint, text string")
    for rows in ([(1, 0, 0, 10), (1, 1, 5, 15)], [(1, 0, 9, 3)]):
        with pytest.raises(Exception, match="overlap"):
            token_counts.token_counts(docs, spark.createDataFrame(rows, "doc_id bigint, section bigint, first_char bigint, end_char bigint")).collect()


def test_licenses(docs):
    rows = {r.doc_id: r for r in license_scan.license_report(docs).collect()}
    row = rows[51]
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (13, 3, 3, 9)
    assert row.base_labels == "cc-by,gpl,mit" and "mit" in row.labels and row.score == 1.0
    assert rows[30].labels == "" and rows[30].first_word is None


def test_licenses_are_told_from_their_neighbours(spark):
    texts = {
        "licensed under the GNU General Public License": "gpl",
        "Licensed under CC BY 4.0": "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.": "cc-by",
        "Released under the Apache License": "apache",
        "subject to the terms of the GNU General Public License": "gpl",
        "look under the bonnet: released yesterday, the new license plate": "",
        "This library is licensed under the GNU Lesser General Public License.": "lgpl",
        "subject to the terms of the Mozilla Public License, v. 2.0": "mpl",
        "Released under the MIT License": "mit",
        "Licensed under CC BY-NC 4.0": "cc-by,cc-by-nc",  # the base phrase stands in it
        "Creative Commons Attribution-NonCommercial License": "cc-by-nc",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files": "mit",
        "obtaining a copy of this software, granted to any person, hereby free: charge is permission of": "",
        "words " * 60 + "Redistribution and use in source and binary forms, with or without modification, are permitted provided": "bsd",
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.labels for r in license_scan.license_report(docs).collect()}
    assert got == dict(enumerate(texts.values()))


def test_phrase_places_of_many_hits():
    words = [b"x", b"mit", b"license", b"cc", b"by", b"mit", b"license"] * 300
    got = license_scan.phrase_places(words, license_scan.BASE_PHRASES)
    want = [(i, "mit") for i, w in enumerate(words) if w == b"mit"] + [(i, "cc-by") for i, w in enumerate(words) if w == b"cc"]
    assert got == sorted(want)


def test_license_filters_find_every_block():
    rng = random.Random(3)
    vocabulary = [b"w%d" % i for i in range(40)]
    templates = [(str(k), " ".join(w.decode() for w in rng.sample(vocabulary, 6))) for k in range(8)]
    known = license_scan.ordered(templates, {w: rng.randint(0, 5) for w in vocabulary}, 0.8)
    index = defaultdict(list)
    for k, t in enumerate(known):
        for place, token in enumerate(t.prefix):
            index[token].append((k, place))
    words = [rng.choice(vocabulary) for _ in range(200)]
    got = {(a, t.number) for a, _, t, _ in license_scan.block_matches(words, known, index, 16)}
    want = {
        (a, t.number)
        for a in range(0, 200, 8)
        for t in known
        if len(set(words[a : a + 16]) & set(t.tokens)) >= t.need
    }
    assert got == want


def test_personal_data(docs, texts):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def base(text):
        out = []
        for kind, pattern in patterns.items():
            for m in re.finditer(pattern, text):
                s, digits = m.group(), re.sub(r"[^0-9]", "", m.group())
                if kind == "ip" and any(int(p) > 255 for p in s.split(".")):
                    continue
                if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                    continue
                if kind == "phone" and not 9 <= len(digits) <= 15:
                    continue
                out.append((kind, m.start(), m.end()))
        return out

    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice(["a", "@", ".", "1", "25", "+", " ", "-", "(", "b.c", "é", "4111111111111111"]) for _ in range(40))
        assert pii.base_spans(text) == base(text), text
    found = {r.doc_id: r for r in pii.pii_report(docs).collect()}
    row = found[50]
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)
    masked = {r.doc_id: r.text for r in pii.mask(docs).collect()}
    assert masked[50].startswith("mail <EMAIL> or <IP>, call <PHONE>. Card <CARD>;")
    assert masked[0] is None and masked[30] == dict(texts)[30]


def test_bootstrapping_reaches_unseen_identifiers(spark):
    rows = [(i, f"user password={hashlib.md5(b'%d' % i).hexdigest()} end") for i in range(40)]
    rows += [(100 + i, f'set token = "{hashlib.sha1(b"t%d" % i).hexdigest()}" here and 12 more') for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.n_id for r in pii.pii_report(docs).collect()}
    assert sum(found[100 + i] for i in range(40)) >= 36


def test_values_of_seed_keys_are_identifiers(spark):
    token = [hashlib.md5(b"%d" % i).hexdigest() for i in range(12)]
    rows = [(i, f"user password={token[i]} end") for i in range(12)]
    rows += [(100, f"seen {token[3]} there"), (101, "password=hunter2 and hunter2"), (102, 'SECRET: "swordfish", swordfish.')]
    rows += [(103, "password=a.b@c.example.org"), (104, "api_key = ab10.0.0.1 x"), (105, "mypassword=swordfish on 2024-01-02"), (106, "passwd=...")]
    rows += [(None, f"password={token[5]}"), (7, f"passwd: {token[7]}x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = [(r.doc_id, r.n_id) for r in pii.pii_report(docs).collect()]
    want = [(i, 1) for i in range(12)] + [(100, 1), (101, 1), (102, 1), (103, 0), (104, 1), (105, 0), (106, 0), (None, 1), (7, 1)]
    assert sorted(found, key=str) == sorted(want, key=str)
    masked = sorted(((r.doc_id, r.text) for r in pii.mask(docs).collect()), key=str)
    want = [(i, "user password=<ID> end") for i in range(12)]
    want += [(100, "seen <ID> there"), (101, "password=<ID> and hunter2"), (102, 'SECRET: "<ID>", swordfish.'), (103, "password=<EMAIL>")]
    want += [(104, "api_key = <ID> x"), (105, rows[17][1]), (106, "passwd=..."), (None, "password=<ID>"), (7, "passwd: <ID>")]
    assert masked == sorted(want, key=str)


def test_decontamination(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, prose(rng.randint(12, 150)) + ". " + prose(5) + ".") for i in range(30)] + [(30, None), (31, ""), (None, prose(20))]
    docs = [(i, prose(200) + " " + items[i % 30][1] + " " + prose(150)) for i in range(0, 60, 3)]
    docs += [(100 + i, prose(400)) for i in range(40)] + [(200, None), (201, "")]
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got == {(i, i % 30) for i in range(0, 60, 3)}
    kept = decontamination.decontaminate(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    assert {r.doc_id for r in kept.collect()} == {*range(100, 140), 200, 201}
    index = decontamination.build([(i, t) for i, t in items if t], {}, 40, 50.0)
    texts = [license_scan.words_of(t or "") for _, t in docs]
    got = {r[:3] for r in decontamination.retrieve(texts, index, 0.5)}
    want = set()
    for i, w in enumerate(texts):
        for first in range(0, max(1, len(w)), decontamination.PART):
            score = defaultdict(float)
            for t in {index.vocabulary.get(x, 0) for x in w[first : first + 2 * decontamination.PART]} - {0}:
                for part, x in index.postings[t]:
                    score[part] += x
            want |= {(i, first, p) for p, s in score.items() if s >= 0.5 - 1e-9}
    assert got == want


@pytest.mark.parametrize("chunk", [64, 100, 5000])
def test_top_k(spark, chunk):
    rng = np.random.default_rng(0)
    rows = [(int(i), [float(x) for x in rng.normal(size=8)], "clash", 1) for i in range(400)]
    rows += [(i, v, None, 2) for i, v in [(400, None), (450, [float("nan")] * 8), (451, [None] * 8), (7, rows[7][1])]]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string, rank int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(vectors, chunk=chunk).collect())
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _, _ in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, (i, v) in enumerate(whole):
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for p, (j, w) in enumerate(whole) if p != q)[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert got == sorted(want)


def test_top_k_of_odd_vectors(spark):
    rows = [(0, [1.0] * 8), (50, [2.0] * 8), (None, [1.0] * 8), (500, []), (550, [1e30] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in topk.top_k(vectors).collect()}
    assert got[0, 50] == got[50, 0] == 8 * 256 * 512
    assert topk.top_k(vectors.limit(0)).count() == 0


def test_top_k_keeps_query_groups_off_the_driver(spark):
    """Many chunks: the groups are neither copied for each chunk nor broadcast,
    which would bring chunks x queries to the driver."""
    rng = np.random.default_rng(3)
    e = rng.normal(size=(900, 6))
    found = topk.top_k(spark.createDataFrame([(i, list(map(float, x))) for i, x in enumerate(e)], "vec_id bigint, embedding array<double>"), chunk=20)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())
    whole = np.floor(256 * e).astype(np.int64)
    want = []
    for q in range(0, 900, 50):
        best = sorted((-int(whole[q] @ w), j) for j, w in enumerate(whole) if j != q)[:5]
        want += [(q, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert got == sorted(want)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan
    assert "Broadcast" not in plan and "Generate" not in plan


def test_top_k_of_dense_queries(spark):
    """Every vector is a query: a chunk's queries are cut into pieces.  Rows
    come with lengths of their own, repeated ids and equal vectors."""
    rng = np.random.default_rng(4)
    rows = [(i % 2400, [float(x) for x in rng.integers(-3, 4, size=4 + (i % 7 == 0))]) for i in range(2500)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for chunk in (5000, 700):
        queries = topk.top_k(vectors, k=3, every=1, chunk=chunk)
        got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in queries.collect())
        m = np.zeros((len(rows), 5), np.int64)
        for i, (_, v) in enumerate(rows):
            m[i, : len(v)] = 256 * np.array(v)
        ids, score, want = np.array([i for i, _ in rows]), m @ m.T, []
        for q in range(len(rows)):
            order = [j for j in np.lexsort((ids, -score[q])) if j != q][:3]
            want += [(int(ids[q]), k + 1, int(ids[j]), int(score[q, j])) for k, j in enumerate(order)]
        assert got == sorted(want)


def test_top_k_search_goes_on_from_what_was_found_before():
    rng = np.random.default_rng(6)
    e = rng.integers(-9, 10, size=(300, 5))
    halves = [topk.Chunk(np.arange(b, b + 150).tobytes(), e[b : b + 150].tobytes(), 5, block=16) for b in (0, 150)]
    none, own = np.full(40, topk._NONE), np.full(40, -1)
    best = topk.nothing_found(40, 4)
    for half in halves:
        topk.search(half, e[:40], 4, none, np.arange(40) if half is halves[0] else own, best)
    for q in range(40):
        want = sorted((-int(e[q] @ w), j) for j, w in enumerate(e) if j != q)[:4]
        assert [*zip(best[0][q], best[1][q], strict=True)] == [(-s, j) for s, j in want]


def test_top_k_of_narrow_and_wide_numbers(spark):
    """Chunks keep their numbers narrow; bounds and products are whole."""
    for m in (np.zeros((2, 0), np.int64), np.array([[-128, 127]]), np.array([[-129, 3]]), np.array([[1 << 40, -(1 << 31)]]), np.array([[-(1 << 63)]])):
        assert np.array_equal(topk._wide(topk._narrow(m).tobytes(), *m.shape), m)
    assert not topk._float_ok(np.array([[-(1 << 63)]])) and topk._float_ok(np.array([[-128]], np.int8))
    rng = np.random.default_rng(8)
    whole = rng.choice([-128, -127, 0, 127], size=(200, 4))
    whole[::37] *= 1000
    whole[50] *= 3_000_000
    rows = [(i, [float(x) / 256 for x in v]) for i, v in enumerate(whole)]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), every=10, chunk=30)
    want = []
    for q in range(0, 200, 10):
        best = sorted((-sum(int(a) * int(b) for a, b in zip(whole[q], w, strict=True)), j) for j, w in enumerate(whole) if j != q)[:5]
        want += [(q, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()) == sorted(want)


def test_decontamination_of_odd_tables(spark):
    """Empty tables on either side, clashing columns, an item of one word."""
    docs = spark.createDataFrame([(1, "the city of Paris lies there", "x", 2.0), (2, "nothing of it", "y", 1.0), (None, None, None, None)], "doc_id bigint, text string, item_id string, score double")
    items = spark.createDataFrame([(7, "Paris", "clash")], "item_id bigint, text string, doc_id string")
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()} == {(1, 7)}
    left = decontamination.decontaminate(docs, items)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {2, None}
    assert decontamination.contaminated(docs.limit(0), items).count() == 0
    assert decontamination.contaminated(docs, items.limit(0)).count() == 0
    assert decontamination.decontaminate(docs.limit(0), items).count() == 0
    assert decontamination.decontaminate(docs, items.limit(0)).count() == 3


def test_toxicity(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("aeioustrnl") for _ in range(rng.randint(2, 8))) for _ in range(800)]
    insults = ["blockhead", "dimwitted", "numbskull"]
    make = lambda bad: [[rng.choice(words) for _ in range(12)] for _ in range(4)] + ([[rng.choice(insults) for _ in range(2)] + [rng.choice(words)]] if bad else [])
    rows = [(k, k % 2, n, sorted(set(s))) for k in range(300) for n, s in enumerate(make(k % 2))]
    model = toxicity.train(spark.createDataFrame(rows, "id bigint, toxic int, sentence int, words array<string>").repartition(3))
    scorer = toxicity._Scorer(model)
    held = [(" ".join(w for s in make(k % 2) for w in s), k % 2) for k in range(200)]
    right = sum((s >= toxicity.THRESHOLD) == bool(y) for s, (_, y) in zip(scorer.score([t for t, _ in held]), held))
    assert right >= 190
    clean, spelled, gapped = scorer.score(["", "you b l o c k h e a d n-u-m-b-s-k-u-l-l", "blockhead blookkhead numb.skull"])
    assert clean < 0.5 < spelled and gapped > clean
    assert abs(toxicity.kernel("idiot", "idiot") - 1) < 1e-5 and toxicity.kernel("idiot", "idxiot") > 0.3 > toxicity.kernel("idiot", "planet")


def _plain_kernel(a, b):
    """All three-letter subsequences, one by one."""
    def weights(word):
        word, out = f"^{word}^", defaultdict(float)
        for i, j, k in ((i, j, k) for i in range(len(word)) for j in range(i + 1, len(word)) for k in range(j + 1, len(word))):
            if k - i < toxicity.SPAN:
                out[word[i] + word[j] + word[k]] += toxicity.DECAY ** (k - i + 1)
        return out

    x, y = weights(a), weights(b)
    dot = lambda p, q: sum(v * q.get(t, 0) for t, v in p.items())
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5


def test_kernel_against_all_subsequences():
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9))) for _ in range(30)]
    words += ["дурак", "дуррак", "дом", "漢字", "idiot", "idi.ot"]
    words = [toxicity.letters(w) for w in words]
    for a in words:
        for b in words:
            assert toxicity.kernel(a, b) == pytest.approx(_plain_kernel(a, b), abs=1e-5)
    assert toxicity.kernel("дурак", "дуррак") > 0.5 > toxicity.kernel("дурак", "дом")
    assert toxicity.letters("Über!") == "über" and toxicity.letters("漢字") == "漢字"


def test_landmarks_give_the_kernel_back():
    """With all words as landmarks, z is an exact feature map of the kernel."""
    rng = random.Random(13)
    words = sorted({"".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 8))) for _ in range(40)})
    model = toxicity._fit_words(words[:10], words[10:], words)
    gram = np.array([[_plain_kernel(a, b) for b in words] for a in words])
    root = toxicity._inverse_root(gram)
    y = np.array([1.0] * 10 + [-1.0] * (len(words) - 10))
    w = toxicity._svm(gram @ root, y, np.where(y > 0, (len(words) - 10) / 10 / 4, 1.0), ridge=1.0)
    assert model.words(words) == pytest.approx(gram @ root @ w[:-1] + w[-1], abs=1e-3)


def test_training_sample_takes_one_text_of_an_id(spark):
    known = [i for i in range(30) if zlib.crc32(b"%d" % i) % 3 != 1]
    hot, unlike, empty = known[:3]
    rows = [(i, f"text of {i}.") for i in range(30)] + [(hot, f"text of {hot}.")] * 50 + [(unlike, "another text.")] * 50 + [(empty, None), (None, "x")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id bigint, toxic int")
    got = {}
    for r in toxicity.training_sample(spark.createDataFrame(rows, "doc_id bigint, text string"), labels).collect():
        got.setdefault((r.id, r.toxic), set()).update(r.words)
    assert got == {(i, i % 2): set(toxicity.units("another text" if i == unlike else f"text of {i}")) for i in known}


def test_toxicity_of_odd_tables(spark):
    """Empty tables, null rows, clashing names, no labels of one class."""
    docs = spark.createDataFrame([(i, f"word{i} fool{i % 2}." * 3, 9.0, "x") for i in range(60)] + [(None, None, 1.0, "y"), (7, "", 2.0, None)], "doc_id bigint, text string, _llm_score double, _llm_text string")
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(60)], "doc_id bigint, toxic int, text int")
    none, nothing = docs.limit(0), labels.limit(0)
    assert toxicity.toxicity_report(none, labels).count() == 0
    low = toxicity.toxicity_report(docs, nothing).collect()
    assert len(low) == 62 and all(r.score < 0.1 and r.predicted == 0 for r in low)
    one = toxicity.toxicity_report(docs, labels.filter("toxic = 1")).collect()
    assert all(r.predicted == 0 for r in one)
    model = toxicity.fit(docs, labels)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {None, *range(0, 60, 2)} - {7}


def test_pipeline_and_registration(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "bpe"]
    names = list(queries.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf).collect()
    kept = {r.doc_id for r in out}
    clean = corpus_pipeline.drop_contaminated(spark, corpus_pipeline.drop_near_duplicates(spark, corpus_pipeline.drop_toxic(spark, docs, sf), sf), sf)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.select("doc_id").collect()} == kept
    masked = {r.doc_id: r.text for r in corpus_pipeline.mask_personal_data(spark, clean, sf).collect()}
    assert all(r.decoded == masked[r.doc_id] and r.n_tokens * 4 == len(r.ids) for r in out)


def test_pipeline_keeps_one_row_of_each_component(spark):
    import corpus_pipeline

    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    one, two, three, four = (prose(100) for _ in range(4))
    near = lambda t: t + " end"
    rows = [(5, one), (5, one), (5, one), (None, near(one)), (9, near(one))]  # repeated rows and a copy without an id
    rows += [(None, two), (None, two), (None, near(two))]  # no ids at all
    rows += [(3, three), (9, near(three)), (9, four)]  # 9 goes twice, but not its unlike text
    rows += [(None, None), (7, "")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, extra int").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    left = [(r.doc_id, r.text) for r in got.collect()]
    assert [x for x in left if x[0] is None and x[1]][0][1] in (two, near(two))
    want = [(5, one), (3, three), (9, four), (None, None), (7, "")]
    assert sorted([x for x in left if x[1] not in (two, near(two))], key=str) == sorted(want, key=str)
    assert len(left) == len(want) + 1


def test_candidates_follow_the_size_of_a_family(spark, monkeypatch):
    """A family of one text with one to four of 60 words replaced: twice the
    members make about twice the candidates."""
    made = []
    distinct = type(spark.range(1)).distinct

    def count(self):
        if self.columns == ["a", "b"]:  # candidates on their way to be verified, and edges
            made.append(self.count())
        return distinct(self)

    monkeypatch.setattr(type(spark.range(1)), "distinct", count)
    rng = random.Random(21)
    base = [f"w{rng.randrange(10**6)}" for _ in range(60)]

    def family(n):
        out = []
        for _ in range(n):
            copy = list(base)
            for at in rng.sample(range(60), rng.randint(1, 4)):
                copy[at] = f"v{rng.randrange(10**6)}"
            out.append(" ".join(copy))
        return out

    totals = []
    for n in (150, 300):
        made.clear()
        texts = family(n)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
        totals.append(sum(made))
        sets = [set(near_dedup.shingles(t).tolist()) for t in texts]
        name = list(range(n))
        links = [(a, b) for a in name for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
        for _ in range(n):
            before = list(name)
            for a, b in links:
                name[a] = name[b] = min(name[a], name[b])
            if name == before:
                break
        assert got == dict(enumerate(name))
    assert totals[1] < 2.8 * totals[0], totals


def _traits(spark, sketches):
    rows = [(i, n, *mins) for i, (n, mins) in sketches.items()]
    return spark.createDataFrame(rows, "id bigint, n bigint, " + ", ".join(f"{c} bigint" for c in near_dedup._planes(near_dedup.BINS)))


def test_pairs_that_cannot_be_links_are_not_made(spark):
    """Members of one group or bucket that share a shingle, as by a common line,
    and are not alike; of sixty, two are."""
    rng = np.random.default_rng(3)
    one = rng.integers(0, 1 << 62, 90, dtype=np.uint64)
    sets = {i: rng.integers(0, 1 << 62, 90, dtype=np.uint64) for i in range(1, 60)} | {0: one}
    sets[7] = np.concatenate([one[:85], sets[7][:5]])
    traits = _traits(spark, {i: (90, near_dedup.planes(near_dedup.sketch(np.sort(x)))) for i, x in sets.items()})
    alike = near_dedup._alike(75, near_dedup.BINS, near_dedup.LEAST_EQUAL)
    rows = spark.createDataFrame([(5, i, i, [1, 2]) for i in sets], "grp bigint, rep bigint, comp bigint, extra array<bigint>")
    assert {tuple(r) for r in near_dedup.outside_pairs(rows, traits, alike).collect()} == {(0, 7)}
    bucket = spark.createDataFrame([(k, i, i) for k in range(40) for i in (0, 7, 10 + k % 40)], "key bigint, rep bigint, comp bigint")
    assert {tuple(r) for r in near_dedup.drawn_pairs(bucket, traits, 0, alike).collect()} == {(0, 7)}


def test_later_links_are_joined_to_components_found_before(spark, monkeypatch):
    seen, components = [], near_dedup.components
    monkeypatch.setattr(near_dedup, "components", lambda edges: seen.append(edges.count()) or components(edges))
    rng = random.Random(2)
    first = [(a, a + 1) for a in range(0, 300, 2)] + [(a, a + 2) for a in range(0, 100, 10)]
    new = [(rng.randrange(400), rng.randrange(400)) for _ in range(40)] + [(500, 501)]
    found = components(spark.createDataFrame(first, "a bigint, b bigint"))
    joined = near_dedup.joined_components(found, spark.createDataFrame(new, "a bigint, b bigint"))
    want = components(spark.createDataFrame(first + new, "a bigint, b bigint"))
    # a node whose only link is to itself may be there, as its own component
    got = {r.node: r.component for r in joined.collect()}
    want = {r.node: r.component for r in want.collect()}
    assert {n: c for n, c in got.items() if n in want or n != c} == want
    assert seen == [len(new)]  # not the first links once more


def test_words_encode_as_the_library_does():
    """Words of printable ASCII, cut into pieces, and all others."""
    enc, rng = tokens.Encoder(tokens.default_path(), cache_words=2000), random.Random(14)
    assert enc.usual
    letters = [chr(c) for c in range(33, 127)] + ["é", "漢", "\n", "\t", "'s", "'ll", "'re", "'t", "12", "aaa", "don't", "<|endoftext|>"]
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 9))) for _ in range(4000)] + ["'S", "''s", "x" * 500, "1a2b3c" * 30]
    for space in ("", " "):
        assert enc._of_words(words, space) == enc.plain([space + w for w in words])
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    ids, at = enc.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == enc.plain(texts)


def test_latin_words_go_piece_by_piece(monkeypatch):
    """Letters of Latin scripts and single line ends need no whole encoding."""
    enc, rng = tokens.Encoder(tokens.default_path()), random.Random(15)
    letters = [*"aZé9É'sñß.\n,!×÷ªµ½ſƀ\t\x85\xa0Ā'llЖ中_$", "é", "\n\n", " ", *enc.special]
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 9))) for _ in range(6000)]
    for space in ("", " "):
        assert enc._of_words(words, space) == enc.plain([space + w for w in words])
    monkeypatch.setattr(enc, "plain", lambda texts: [None] * len(texts) if texts else [])
    assert all(enc._of_words(["été,", "are.\nRe", "Größe's", "ſtadt12", "end.\n"], " "))


def _new_words(rng, n):
    return ["x" + "".join(rng.choice("abcdefghijklmnop.,é\n") for _ in range(12)) + "x" for _ in range(n)]


def test_rare_words_do_not_fill_a_workers_memory():
    """Text after text of words never met before: the encoder keeps few of them,
    and those that come again and again."""
    enc, rng = tokens.Encoder(tokens.default_path()), random.Random(16)
    often = _new_words(rng, 1000)
    for k in range(12):
        # the last texts' new words come twice
        words = _new_words(rng, 15_000)
        enc.encode([" ".join(["a", *often, *words])])
        if k > 9:
            enc.encode([" ".join(["a", *words])])
    kept = [w for part in enc.inner for w in part]
    assert len(kept) == len(set(kept)) < 60_000, len(kept)
    assert set(often) <= set(kept)


def test_kept_words_stay_bounded_and_encode_the_same(monkeypatch):
    monkeypatch.setattr(tokens, "_MARKS", 1 << 10)  # marks meet and are cleared
    enc, rng = tokens.Encoder(tokens.default_path(), cache_words=600), random.Random(17)
    words = _new_words(rng, 3000)
    for _ in range(30):
        texts = [" ".join(rng.choices(words, k=40)) for _ in range(20)]
        ids, at = enc.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == enc.plain(texts)
        assert sum(map(len, enc.inner)) <= 600 + 800


def test_a_batch_becomes_python_texts_slice_by_slice(spark):
    import pyarrow as pa
    from shoplens.llm import common

    batch = pa.record_batch({"doc_id": [1, None, 3, 4, 5], "text": ["aé漢", None, "", "x" * 9, "yy"]})
    got = list(common.text_slices(batch, 5))
    assert got == [(0, 3, ["aé漢", "", ""]), (3, 4, ["x" * 9]), (4, 5, ["yy"])]
    texts = [t or "" for t in batch.column(1).to_pylist()]
    assert [g[:2] for g in got] == list(common.slices(batch, texts, 5))


def test_a_token_file_is_packed_without_copies_of_its_ids():
    import tracemalloc

    ids = np.arange(2_000_000, dtype=np.uint32).astype(np.uint16)
    ends = np.arange(1, 1001) * 2000
    tracemalloc.start()
    try:
        data = token_files.TokenFile.pack(list(range(1000)), ids, ends, 2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 1.5 * len(data), (peak, len(data))
    back = token_files.TokenFile(data)
    assert np.array_equal(back.ids, ids) and back.ends.all().tolist() == ends.tolist() and back.doc_ids() == list(range(1000))
    wide = token_files.TokenFile(token_files.TokenFile.pack([None, 7], np.array([1, 70_000, 2]), np.array([1, 3]), 4))
    assert wide.document(1).tolist() == [70_000, 2] and wide.doc_ids() == [None, 7]
