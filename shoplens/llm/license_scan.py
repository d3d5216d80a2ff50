"""License notices by an exact containment join (operator 5).

Blocks are windows of ``BLOCK`` words, half overlapping, so each template (at
most ``BLOCK`` / 2 words) that stands in a text stands whole in one block.
The template's words, as a set of m tokens, must be contained in the block's
set to at least ``THRESHOLD``, that is in o = ceil(threshold * m) tokens:

* tokens are ordered by their document frequency over the whole corpus, rarest
  first; a block can only qualify if it holds one of the template's first
  m - o + 1 tokens (prefix filter);
* it needs at least o distinct words (length filter);
* if the block's first common token is at place i of the template's order, at
  most m - i tokens can be common (positional filter);
* what is left is counted in full.

Sets alone cannot tell "GNU General Public License" from "GNU Lesser General
Public License", so a template may have a *key*: words that must stand in the
block one after another, and not as the beginning of one of the longer phrases
that it excludes ("creative commons attribution" is not "... noncommercial").

The templates are a parameter of fixed size and go to the tasks with the
function; the corpus is never shuffled."""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import over_texts

BLOCK, THRESHOLD = 64, 0.8

# The base phrases with their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Sentences of well-known notices: label, text, the key that tells
# it from its neighbours, and longer phrases of the neighbours.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0", "apache license"),
    ("apache", "you may not use this file except in compliance with the License", "except in compliance with the license"),
    (
        "apache",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS',
        "distributed under the license is distributed on an as is basis",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", "gnu general public license"),
    (
        "gpl",
        "free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "gnu general public license",
    ),
    ("lgpl", "licensed under the GNU Lesser General Public License", "gnu lesser general public license"),
    ("lgpl", "under the terms of the GNU Lesser General Public License", "gnu lesser general public license"),
    ("agpl", "under the terms of the GNU Affero General Public License", "gnu affero general public license"),
    ("mit", "Released under the MIT License", "mit license"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "to any person obtaining a copy of this software",
    ),
    (
        "mit",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "this permission notice shall be included in all copies",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "redistribution and use in source and binary forms",
    ),
    (
        "bsd",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
        "contributors may be used to endorse or promote products",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "for any purpose with or without fee is hereby granted",
    ),
    ("mpl", "subject to the terms of the Mozilla Public License", "mozilla public license"),
    (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "creative commons attribution",
        ("creative commons attribution noncommercial", "creative commons attribution sharealike",
         "creative commons attribution noderivatives", "creative commons attribution non", "creative commons attribution share",
         "creative commons attribution no"),
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc", ("cc by nc sa", "cc by nc nd")),
    (
        "cc-by-nc",
        "Creative Commons Attribution NonCommercial License",
        "creative commons attribution noncommercial",
        ("creative commons attribution noncommercial sharealike", "creative commons attribution noncommercial noderivatives",
         "creative commons attribution noncommercial share", "creative commons attribution noncommercial no"),
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain", "free and unencumbered software"),
]

_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEPT else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) runs of 0-9, a-z and non-ASCII characters, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


@dataclass
class Template:
    number: int
    label: str
    tokens: list[bytes]  # rarest first
    need: int
    key: bytes = b""
    unless: tuple[bytes, ...] = ()

    @property
    def prefix(self) -> list[bytes]:
        return self.tokens[: len(self.tokens) - self.need + 1]

    def keyed(self, words: list[bytes]) -> bool:
        """Whether the key stands among the words, not within an excluded phrase."""
        if not self.key:
            return True
        line = b" " + b" ".join(words) + b" "
        at = line.find(self.key)
        while at >= 0:
            if not any(line.startswith(phrase, at) for phrase in self.unless):
                return True
            at = line.find(self.key, at + 1)
        return False


def _phrase(text: str) -> bytes:
    return b" " + b" ".join(words_of(text)) + b" "


def ordered(templates: list[tuple], frequency: dict[bytes, int], threshold: float) -> list[Template]:
    out = []
    for number, (label, text, *rest) in enumerate(templates):
        tokens = sorted(set(words_of(text)), key=lambda t: (frequency.get(t, 0), t))
        key, unless = (_phrase(rest[0]) if rest else b""), tuple(_phrase(p) for p in (rest[1] if len(rest) > 1 else ()))
        if tokens:
            out.append(Template(number, label, tokens, math.ceil(threshold * len(tokens) - 1e-9), key, unless))
    return out


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """Where the phrases' words stand one after another: (word, label)."""
    line = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in phrases.items():
        key = b" " + phrase.encode() + b" "
        at, seen, number = line.find(key), 0, 0
        while at >= 0:  # words are counted on from the last place
            number, seen = number + line.count(b" ", seen, at), at
            out.append((number, label))
            at = line.find(key, at + 1)
    return sorted(out)


def block_matches(words: list[bytes], templates: list[Template], by_token: dict[bytes, list[tuple[int, int]]], block: int):
    """(first word, end word, template, containment) of qualifying blocks.
    ``by_token`` lists, for prefix tokens, (template, place in its order)."""
    out = []
    hits = [i for i, w in enumerate(words) if w in by_token]
    step = block // 2
    starts = sorted({s for i in hits for s in ((i // step) * step, (i // step - 1) * step) if s >= 0})
    for start in starts:
        tokens = set(words[start : start + block])
        first: dict[int, int] = {}
        for token in tokens & by_token.keys():
            for t, place in by_token[token]:
                first[t] = min(place, first.get(t, place))
        for t, place in first.items():
            template = templates[t]
            m = len(template.tokens)
            if len(tokens) < template.need or m - place < template.need:
                continue
            common = sum(token in tokens for token in template.tokens[place:])
            if common >= template.need and template.keyed(words[start : start + block]):
                out.append((start, min(start + block, len(words)), template, common / m))
    return out


_COUNT = pa.schema([("token", pa.binary()), ("n", pa.int64())])


def _count_rows(vocabulary: frozenset):
    def run(batches):
        from collections import Counter

        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(vocabulary.intersection(words_of(text or "")))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=_COUNT)

    return run


def document_frequency(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """Document frequency of each template token over the whole corpus; as many
    rows come to the driver as the templates have tokens."""
    counts = docs.select("text").mapInArrow(_count_rows(frozenset(vocabulary)), "token binary, n bigint")
    return {bytes(r.token): r.n for r in counts.groupBy("token").agg(F.sum("n").alias("n")).collect()}


_PLACE = pa.struct([("word", pa.int64()), ("label", pa.string())])
_MATCH = pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("template", pa.int64()), ("label", pa.string()), ("containment", pa.float64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("places", pa.list_(_PLACE)), ("matches", pa.list_(_MATCH))])
_OUT_SQL = (
    "doc_id bigint, n_words bigint, places array<struct<word:bigint,label:string>>, "
    "matches array<struct<first_word:bigint,end_word:bigint,template:bigint,label:string,containment:double>>"
)


def _scan(templates: list[Template], phrases: dict[str, str], block: int):
    by_token: dict[bytes, list[tuple[int, int]]] = {}
    for k, template in enumerate(templates):
        for place, token in enumerate(template.prefix):
            by_token.setdefault(token, []).append((k, place))
    seconds = {phrase.split()[-1].encode() for phrase in phrases}
    prefix = frozenset(by_token)

    def rows(ids: list, texts: list[str]) -> dict[str, list]:
        out = {"doc_id": ids, "n_words": [], "places": [], "matches": []}
        for text in texts:
            words = words_of(text)
            out["n_words"].append(len(words))
            places = matches = []
            if not seconds.isdisjoint(words):
                places = [{"word": w, "label": label} for w, label in phrase_places(words, phrases)]
            if not prefix.isdisjoint(words):
                matches = [
                    {"first_word": a, "end_word": b, "template": t.number, "label": t.label, "containment": share}
                    for a, b, t, share in block_matches(words, templates, by_token, block)
                ]
            out["places"].append(places)
            out["matches"].append(matches)
        return out

    return rows


def scan_licenses(
    docs: DataFrame, templates: list[tuple] = TEMPLATES, threshold: float = THRESHOLD, block: int = BLOCK,
    phrases: dict[str, str] = BASE_PHRASES,
) -> DataFrame:
    """(doc_id, n_words, places, matches) of every row: where base phrases
    stand, and every (block, template) whose containment meets the threshold and
    that has the template's key.  A template is (label, text), or (label, text,
    key), or (label, text, key, excluded phrases).

    A null or empty text has no words; repeated rows each give a row; ties of
    frequency are ordered by the token; a template of more than ``block`` / 2
    words is refused; other columns are ignored; an empty table gives an empty
    result."""
    if any(len(words_of(t)) > block // 2 for _, t, *_ in templates):
        raise ValueError("a template is longer than half a block")
    vocabulary = {w for _, t, *_ in templates for w in words_of(t)}
    known = ordered(templates, document_frequency(docs, vocabulary), threshold)
    return docs.select("doc_id", "text").mapInArrow(over_texts(_scan(known, phrases, block), _OUT), _OUT_SQL)


def license_report(docs: DataFrame) -> DataFrame:
    """Labels per document, from ``scan_licenses``."""
    found = scan_licenses(docs)
    base, word = F.col("places.label"), F.col("places.word")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    n_base = F.size("places").cast("bigint")
    return found.select(
        "doc_id",
        "n_words",
        n_base.alias("n_base"),
        F.array_min(word).alias("first_word"),
        F.array_max(word).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.col("matches.label"))).alias("labels"),
        F.when(n_base > 0, F.lit(1.0))
        .otherwise(F.coalesce(F.array_max(F.col("matches.containment")), F.lit(0.0)))
        .alias("score"),
    )
