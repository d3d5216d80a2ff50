"""Toxic documents by a string-kernel support vector machine (operator 6).

The kernel compares two words by their common subsequences of three letters,
gaps allowed: a subsequence that spans s letters (``SPAN`` at most) weighs
DECAY^s, and the kernel is normalised.  An insult with gaps or inserted
characters keeps most of its subsequences.  Words are lowered, look-alike
digits and signs read as letters, other signs dropped, and spelled-out words
("i d i o t") joined.

Nystroem: with landmark words L, z(x) = K(L, L)^(-1/2) k(x, L), and a linear
SVM on z.  Its decision value is a sum over the word's own subsequences, so
landmarks and weights fold into one table of 32^3 numbers and scoring a word
costs its subsequences alone.

The letters a to z have codes of their own; subsequences with any other letter
are hashed to as many numbers again, so accented letters and words of other
scripts are compared by their own letters too.

Training is on labelled sentences: those of a bounded sample of labelled
documents (``SAMPLE`` of each class, by hash of the id) inherit the document's
label.  A toxic document has toxic sentences, but not all of its are, so, as in
multiple-instance SVMs, a sentence stands by its most telling word (by a lower
estimate of the class ratio) and a toxic document by its two most telling
sentences; clean sentences stand by all words.  The document's score is a logistic
function, fitted on the same sample, of its best words' decision values.

The sentences stay on the executors: words are counted per class, witnesses
found and words scored there.  The driver holds words in bounded numbers
(``CLEAN_WORDS``, ``HARD``, two of each toxic document) and two values a document.
"""

from __future__ import annotations

import itertools
import re
import uuid
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .common import free_name, slices, stage, take_over

SAMPLE = 3_000  # labelled documents of each class used for training, at most
CLEAN_WORDS = 12_000  # distinct clean words used as negative instances, at most
LANDMARKS = 320
ROUNDS, HARD = 2, 1_500  # of hard clean words
SPAN, DECAY, LETTERS, WINDOW = 5, 0.6, 32, 24
#: Subsequences of Latin letters, and as many numbers that others hash to.
FEATURES = 2 * LETTERS**3
THRESHOLD = 0.7
SOME = 2_000  # words whose subsequences are held at once

#: Digits and signs read as letters.
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_SPELLED = re.compile(r"(?<!\S)\w(?:[^\w\s]*\s+\w){2,}(?!\w)")
_NOT_LETTER = re.compile(r"[\W_]+")
_ENDS = re.compile(r"[.!?\n]+")


def letters(word: str) -> str:
    """A word's letters in lower case, without other signs."""
    word = word.lower().strip(".!?,;:\"'()[]|#*%&")
    if not word.isalpha():
        word = _NOT_LETTER.sub("", word.translate(LOOKALIKE))
    return word


def pieces(word: str) -> list[str]:
    """Overlapping windows of a very long word; a short one is its own."""
    if len(word) <= WINDOW:
        return [word]
    return [word[i : i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]


def _codes(word: str) -> list[int]:
    return [27] + [ord(c) - 96 if "a" <= c <= "z" else LETTERS + ord(c) for c in word] + [27]


@lru_cache(maxsize=64)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all three-letter subsequences of n letters; their weights."""
    found = [(i, j, k) for i in range(n) for j, k in itertools.combinations(range(i + 1, min(n, i + SPAN)), 2)]
    places = np.array(found, np.int64).reshape(-1, 3)
    return places, DECAY ** (places[:, 2] - places[:, 0] + 1.0)


def features(words: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For words of each length: their places in the list, the subsequences of
    each (sorted) and the weights, a repeated one's summed into its first."""
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        by_length.setdefault(len(word), []).append(i)
    out = []
    for n, rows in by_length.items():
        codes = np.array([_codes(words[i]) for i in rows], np.int64)
        places, weight = _triples(n + 2)
        if not len(places):
            continue
        first, second, third = (codes[:, places[:, k]] for k in range(3))
        ids = (first * LETTERS + second) * LETTERS + third
        if (codes >= LETTERS).any():
            other = np.maximum(np.maximum(first, second), third) >= LETTERS
            mixed = (first * 0x9E3779B1 + second * 0x85EBCA77 + third * 0xC2B2AE3D) * 0x27D4EB2F
            ids = np.where(other, LETTERS**3 + (mixed >> 15) % LETTERS**3, ids)
        order = np.argsort(ids, axis=1)
        ids, w = np.take_along_axis(ids, order, 1), weight[order]
        new = np.ones(ids.shape, bool)
        new[:, 1:] = ids[:, 1:] != ids[:, :-1]
        flat = np.flatnonzero(new.ravel())
        sums = np.zeros(ids.size)
        sums[flat] = np.add.reduceat(w.ravel(), flat)
        out.append((np.array(rows), ids, sums.reshape(ids.shape)))
    return out


def dense(words: list[str]) -> np.ndarray:
    """Normalised feature vectors, for landmarks and tests."""
    out = np.zeros((len(words), FEATURES), np.float32)
    for rows, ids, w in features(words):
        norm = np.sqrt((w * w).sum(1, keepdims=True))
        np.add.at(out, (np.repeat(rows, ids.shape[1]), ids.ravel()), (w / norm).ravel())
    return out


def kernel(a: str, b: str) -> float:
    x = dense([a, b])
    return float(x[0] @ x[1])


@dataclass
class Model:
    table: np.ndarray  # a weight for each subsequence
    bias: float
    logistic: tuple[float, float, float]

    def words(self, words: list[str]) -> np.ndarray:
        """Decision values, some words at a time: a word has up to 150 subsequences."""
        out = np.full(len(words), self.bias)
        for begin in range(0, len(words), SOME):
            part = out[begin : begin + SOME]
            for rows, ids, w in features(words[begin : begin + SOME]):
                part[rows] += (self.table[ids] * w).sum(1) / np.sqrt((w * w).sum(1))
        return out

    def document(self, best: np.ndarray, second: np.ndarray) -> np.ndarray:
        a, b, c = self.logistic
        return 1 / (1 + np.exp(-np.clip(a + b * best + c * second, -40, 40)))


def _inverse_root(k: np.ndarray) -> np.ndarray:
    value, vector = np.linalg.eigh(k)
    keep = value > 1e-6 * value.max()
    return (vector[:, keep] / np.sqrt(value[keep])) @ vector[:, keep].T


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Squared-hinge linear SVM by Newton's method; the last entry is the bias."""
    z = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        active = y * (z @ w) < 1
        za = z[active] * weight[active, None]
        step = np.linalg.solve(za.T @ z[active] + ridge * np.eye(len(w)), za.T @ y[active])
        if np.allclose(step, w, atol=1e-7):
            break
        w = step
    return w


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(h, g)
    return w


def sentences(text: str) -> list[str]:
    return [s for s in _ENDS.split(text) if s.strip()]


def units(text: str) -> list[str]:
    """The words that are scored: every word, and spelled-out ones joined."""
    out = [p for w in text.split() for p in pieces(letters(w)) if p]
    for m in _SPELLED.finditer(text):
        out += pieces(letters(re.sub(r"\s+", "", m.group())))
    return out


def _fit_words(positive: list[str], negative: list[str], marks: list[str]) -> Model:
    """The SVM on words with landmarks ``marks``, folded into a table."""
    found = features(marks)
    # only subsequences of landmarks have a part in k(x, L)
    known = np.unique(np.concatenate([ids[w > 0] for _, ids, w in found]))
    base = np.zeros((len(marks), len(known)))
    for rows, ids, w in found:
        at, w = np.searchsorted(known, ids), w / np.sqrt((w * w).sum(1, keepdims=True))
        there = w > 0
        np.add.at(base, (np.repeat(rows, ids.shape[1])[there.ravel()], at[there]), w[there])
    fold = base.T @ _inverse_root(base @ base.T)  # z of a word: its normalised features @ fold
    place = np.full(FEATURES, len(known))
    place[known] = np.arange(len(known))
    fold = np.vstack([fold, np.zeros(fold.shape[1])]).astype(np.float32)  # the last row: no landmark's
    words = positive + negative
    z = np.zeros((len(words), fold.shape[1]), np.float32)
    for rows, ids, w in features(words):
        w = (w / np.sqrt((w * w).sum(1, keepdims=True))).astype(np.float32)
        some = max(1, 20_000 // ids.shape[1])
        for begin in range(0, len(rows), some):
            part = slice(begin, begin + some)
            z[rows[part]] = np.einsum("nt,ntm->nm", w[part], fold[place[ids[part]]])
    y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
    weight = np.where(y > 0, len(negative) / len(positive) / 4, 1.0)
    w = _svm(z, y, weight, ridge=1.0)
    table = np.zeros(FEATURES)
    table[known] = fold[:-1].astype(np.float64) @ w[:-1]
    return Model(table, float(w[-1]), (0.0, 1.0, 0.0))


NOTHING = Model(np.zeros(FEATURES), -1.0, (-4.0, 0.0, 0.0))  # learnt from nothing: all is clean


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(id, toxic, sentence, words) of at most ``sample`` labelled documents of
    each class, the first by a hash of the id; never of ids whose crc32 mod 3 is
    1.  Of repeated rows of an id, and unlike texts of it, the least text counts,
    once.  ``words`` are the distinct ones of a sentence; a document without
    sentences has one row without words."""
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    order = F.xxhash64("doc_id")
    chosen = [known.filter(F.col("toxic") == c).orderBy(order, "doc_id").limit(sample) for c in (0, 1)]
    wanted = chosen[0].union(chosen[1]).withColumnRenamed("doc_id", "id")
    texts = docs.join(F.broadcast(wanted), F.col("doc_id") == F.col("id")).groupBy("id", "toxic").agg(F.min("text").alias("text"))

    def split(batches):
        take_over("sentences", int)  # it keeps nothing
        for batch in batches:
            for i, text, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = [sorted(set(units(s))) for s in sentences(text or "")] or [[]]
                n = len(words)
                columns = [pa.array([i] * n, pa.int64()), pa.array([int(y)] * n, pa.int32()), pa.array(range(n), pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(words, pa.list_(pa.string()))], ["id", "toxic", "sentence", "words"])

    return texts.select("id", "text", "toxic").mapInArrow(split, "id bigint, toxic int, sentence int, words array<string>")


def _word_values(words: DataFrame, model: Model) -> DataFrame:
    """``words`` (one column ``word``) with the model's ``value``."""
    shipped = words.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 5_000):
                part = batch.slice(begin, 5_000)
                values = shipped.value.words(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values)], ["word", "value"])

    return words.select("word").mapInArrow(run, "word string, value double")


def train(sample: DataFrame) -> Model:
    """Fit on labelled sentences (id, toxic, sentence, words).

    Bounds, on words and not on rows: two words of each toxic document, each the
    most telling of a sentence, ``CLEAN_WORDS`` drawn and a quarter as many frequent clean words,
    and in each of ``ROUNDS`` the ``HARD`` clean words that score worst."""
    sample = stage(sample, "sentences")
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count_distinct("id").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return NOTHING
    said = sample.select("id", "toxic", "sentence", F.explode("words").alias("word"))
    of_documents = said.select("id", "toxic", "word").distinct()
    counts = of_documents.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    rate = F.log(((F.col("a") + 0.5) / (n_toxic + 1)) / ((F.col("b") + 0.5) / (n_clean + 1)))
    # a lower estimate of the log ratio of a word's rates in the classes
    ratio = rate - 1.5 * F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    counts = stage(counts.withColumn("ratio", ratio), "counts")

    best_first = Window.partitionBy("id").orderBy(F.col("ratio").desc(), F.col("word").desc())
    telling = said.filter("toxic = 1").join(counts.select("word", "ratio"), "word")
    witness = telling.groupBy("id", "sentence").agg(F.max(F.struct("ratio", "word")).alias("best"))
    witness = witness.select("id", "best.word", "best.ratio").distinct()
    # at most two words of each sampled toxic document
    two = witness.withColumn("rn", F.row_number().over(best_first)).filter("rn <= 2 AND ratio > 1")
    few = max(2, n_toxic // 1000)
    # at most two words of each sampled toxic document
    picked = {r.word: r.n for r in two.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= few).collect()}
    positive = sorted(picked)
    rest = counts.filter("b > 0")
    if positive:
        taken = rest.sparkSession.createDataFrame([(w,) for w in positive], "word string")
        rest = rest.join(taken, "word", "left_anti")
    rest = stage(rest.select("word", "b"), "clean-words")
    frequent = rest.orderBy(F.col("b").desc(), "word").limit(CLEAN_WORDS // 4)
    drawn = rest.orderBy(F.xxhash64("word", F.lit(7)), "word").limit(CLEAN_WORDS)
    others = [r.word for r in drawn.collect()]  # in the order of a hash
    negative = sorted({*others, *(r.word for r in frequent.collect())})
    if not positive or not negative:
        return NOTHING
    insults = sorted(positive, key=lambda w: (-picked[w], w))[: LANDMARKS // 2]
    model = _fit_words(positive, negative, insults + others[: LANDMARKS - len(insults)])
    for _ in range(ROUNDS):  # the clean words that look worst join the negatives
        worst = _word_values(rest, model).orderBy(F.col("value").desc(), "word").limit(HARD)
        hard = [r.word for r in worst.collect()]
        negative = sorted({*negative, *hard})
        marks = insults + hard[: LANDMARKS // 4] + others
        model = _fit_words(positive, negative, list(dict.fromkeys(marks))[:LANDMARKS])

    scored = of_documents.join(_word_values(counts, model), "word")
    ranked = scored.withColumn("rn", F.row_number().over(Window.partitionBy("id").orderBy(F.col("value").desc(), "word")))
    top = ranked.filter("rn <= 2").groupBy("id").agg(F.max("value").alias("best"), F.min("value").alias("second"))
    rows = sample.select("id", "toxic").distinct().join(top, "id", "left").orderBy("id").collect()
    x = np.array([(-2.0, -2.0) if r.best is None else (r.best, r.second) for r in rows])
    model.logistic = tuple(_logistic(np.clip(x, -2, 2), np.array([float(r.toxic == 1) for r in rows])))
    return model


class _Scorer:
    """Scores texts; keeps the values of words that a worker has met."""

    def __init__(self, model: Model):
        self.model, self.cache = model, {}

    def values(self, words: list[str]) -> np.ndarray:
        cache = self.cache
        if len(cache) > 600_000:
            cache.clear()
        new = [w for w in words if w not in cache]
        if new:
            parts = [pieces(letters(w)) for w in new]
            flat = [p for ps in parts for p in ps]
            some = self.model.words(flat)
            at = 0
            for w, ps in zip(new, parts, strict=True):
                value = float(some[at : at + len(ps)].max()) if ps[0] else -2.0
                at += len(ps)
                if len(w) <= 64:
                    cache[w] = value
                else:
                    self.long[w] = value
        long = self.long
        return np.array([cache[w] if w in cache else long[w] for w in words])

    def score(self, texts: list[str]) -> np.ndarray:
        self.long: dict[str, float] = {}
        spelled = []
        for i, text in enumerate(texts):
            for m in _SPELLED.finditer(text):
                spelled.append((i, re.sub(r"\s+", "", m.group())))
        parts = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
        bounds = np.asarray(parts.offsets).astype(np.int64)
        words = parts.values.dictionary_encode()
        value = self.values(words.dictionary.to_pylist())[np.asarray(words.indices)] if len(words) else np.zeros(0)
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        if spelled:
            value = np.concatenate([value, self.values([w for _, w in spelled])])
            owner = np.concatenate([owner, [i for i, _ in spelled]])
        value = np.clip(value, -2, 2)
        order = np.lexsort((-value, owner))
        owner, value = owner[order], value[order]
        first = np.searchsorted(owner, np.arange(len(texts)))
        best, second = np.full(len(texts), -2.0), np.full(len(texts), -2.0)
        n = np.bincount(owner, minlength=len(texts))
        best[n > 0] = value[first[n > 0]]
        second[n > 0] = best[n > 0]
        second[n > 1] = value[first[n > 1] + 1]
        return self.model.document(best, second)


_SCORERS: dict[str, _Scorer] = {}
_OUT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def _score_rows(model, key: str, name: str):
    def run(batches):
        take_over("scorer", _SCORERS.clear)
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = _Scorer(model.value)
        scorer = _SCORERS[key]
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            score = np.zeros(len(texts))
            for begin, end in slices(batch, texts, 2_000_000):
                score[begin:end] = scorer.score(texts[begin:end])
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(score)], [*batch.schema.names[1:], name])

    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled documents of each class (see
    ``training_sample`` and ``train``); without labels of both classes, or
    without a word that tells them apart, all scores are low."""
    return train(training_sample(docs, labels, sample))


def score(docs: DataFrame, model: Model, name: str = "_llm_score") -> DataFrame:
    """``docs`` with a column ``name`` from 0 to 1 (higher: more likely toxic).

    A null or empty text scores as one without insults; repeated rows score
    alike; other columns pass through and have no part in the score; an empty
    table gives an empty result."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES numbers
    rows = docs.select(F.col("text").alias(free_name(docs, "_llm_text")), *docs.columns)
    schema = StructType([*docs.schema.fields]).add(name, DoubleType())
    return rows.mapInArrow(_score_rows(shipped, uuid.uuid4().hex, name), schema)


def toxicity_report(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, sample))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return scored.select(
        "doc_id",
        held.alias("held_out"),
        F.col("_llm_score").alias("score"),
        (F.col("_llm_score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more."""
    name = free_name(docs, "_llm_score")
    return score(docs, model, name).filter(F.col(name) < threshold).drop(name)
