"""Personal data by bootstrapped contextual extraction (operator 8).

Four kinds have exact rules (email, ip, card, phone).  Their finds, and values
given after a few seed keys, are the seed entities.  Every token that could be
an identifier is an *instance* with lexical *patterns*: the key or the cue
before it, the word to its left, its opening capitals, its shape.  On the
graph of patterns and instances Spark alternates until the accepted patterns stay:

* a pattern's confidence: the mean score of its distinct instances that have
  one (seeds 1, harmless tokens 0, found ones theirs), damped by a harmless
  one, so a pattern needs support;
* an unknown instance's score: the confidence of its best pattern, where that
  reaches ``CONFIDENT`` with at least ``SUPPORT`` instances above it.

Instances found in the end are spans of kind ``id``, and so are values given
after a seed key, whatever they look like, with the other occurrences of the
same token that are not harmless; not what lies in a find of another kind.
Tables hold hashes of tokens; per-key sums are combined before every shuffle."""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, over_texts, stage

CONFIDENT, SUPPORT = 0.9, 10
KINDS = ["email", "ip", "card", "phone", "id"]
SEED_KEYS = frozenset({"password", "passwd", "secret", "api_key"})

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Around each @: the longest local part that no find before it took, and
    the domain after it.  Linear in the text."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            end = match.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; code points."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = [x.lstrip("0") for x in m.group().split(".")]
        if all(len(x) <= 3 and int(x or "0") <= 255 for x in parts):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group()
        if len(digits) >= 13:
            digits = digits.replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


_DIGIT = re.compile(r"[0-9]\S*")
_CUE = re.compile(r"(\w{2,24})\s?[:=]\s?\"?\Z")
_GIVEN = re.compile(r"[:=]\s?\"?")
_VALUE = re.compile(r"[^\s\"'<>(),;=:]+")
_LEFT = re.compile(r"(\w{2,24})\W{0,3}\Z")
_CAPITALS = re.compile(r"[A-Z]{4}")
_DATE = re.compile(r"[0-9]{1,4}([-/.][0-9]{1,4}){1,2}")


def _shape(token: str) -> str | None:
    """Character classes of a longer token, coarsely: hex of any length is one."""
    if len(token) < 12:
        return None
    if all(c in "0123456789abcdef" for c in token):
        return "hex"
    kinds = {"9" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else c for c in token}
    return "".join(sorted(kinds))[:8] + str(min(len(token) // 8, 4))


def _harmless(token: str) -> bool:
    """Short numbers, dates, versions and tokens with next to no digits."""
    digits = sum(c.isdigit() for c in token)
    return len(token) < 8 or digits < 3 or bool(_DATE.fullmatch(token)) or (digits == len(token) and digits < 9)


def _tokens(text: str):
    """(start, token) of the tokens with digits, and of those without that may
    be given after a seed key."""
    end_before = 0
    for found in _DIGIT.finditer(text):
        begin = found.start()
        while begin > end_before and not text[begin - 1].isspace():
            begin -= 1
        end_before = found.end()
        for m in _VALUE.finditer(text, begin, found.end()):
            token = m.group().rstrip(".!?")
            if any(c.isdigit() for c in token):
                yield m.start(), token
    for m in _GIVEN.finditer(text):
        if text[max(0, m.start() - 9) : m.start()].rstrip().lower().endswith(tuple(SEED_KEYS)):
            value = _VALUE.match(text, m.end())
            token = value.group().rstrip(".!?") if value else ""
            if token and not any("0" <= c <= "9" for c in token):
                yield m.end(), token


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, int, int, bool, list[str]]]:
    """(start, end, instance, mark, bare, patterns) of the tokens with digits
    and of all values after a seed key; mark: 2 given after a seed key, 1 seed
    by a find of another kind, -1 harmless, 0 unknown; bare: no such find
    covers it."""
    out = []
    taken = sorted((a, b) for _, a, b in base)
    for start, token in _tokens(text):
        end = start + len(token)
        before = text[max(0, start - 40) : start]
        cue = _CUE.search(before)
        patterns = []
        mark = -1 if _harmless(token) else 0
        if any(a < end and start < b for a, b in taken):
            mark = 1
        if cue:
            key = cue.group(1).lower()
            patterns.append("cue " + key)
            if key in SEED_KEYS:
                mark = 2
        elif left := _LEFT.search(before):
            patterns.append("left " + left.group(1).lower())
        if mark < 2 and not any(c.isdigit() for c in token):
            continue
        if _CAPITALS.match(token):
            patterns.append("capitals " + token[:4])
        if shape := _shape(token):
            patterns.append("shape " + shape)
        if patterns:
            instance = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass")) - (1 << 63)
            bare = not any(a <= start and end <= b for a, b in taken)
            out.append((start, end, instance, mark, bare, patterns))
    return out


_SPAN = pa.struct([("kind", pa.string()), ("first", pa.int64()), ("end", pa.int64())])
_CAND = pa.struct([("first", pa.int64()), ("end", pa.int64()), ("instance", pa.int64()), ("mark", pa.int64()), ("bare", pa.bool_()), ("patterns", pa.list_(pa.string()))])
_OUT = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("base", pa.list_(_SPAN)), ("cands", pa.list_(_CAND))])
_OUT_SQL = (
    "doc_id bigint, key bigint, base array<struct<kind:string,first:bigint,end:bigint>>, "
    "cands array<struct<first:bigint,end:bigint,instance:bigint,mark:bigint,bare:boolean,patterns:array<string>>>"
)


def _rows(ids: list, texts: list[str]) -> dict[str, list]:
    out = {"doc_id": [i["doc_id"] for i in ids], "key": [i["key"] for i in ids], "base": [], "cands": []}
    for text in texts:
        base = base_spans(text)
        out["base"].append([{"kind": k, "first": a, "end": b} for k, a, b in base])
        out["cands"].append(
            [dict(zip(("first", "end", "instance", "mark", "bare", "patterns"), c, strict=True)) for c in candidates(text, base)]
        )
    return out


def bootstrap(occurrences: DataFrame, confident: float = CONFIDENT, support: int = SUPPORT) -> DataFrame:
    """Instances found by the alternation, from (instance, mark, pattern).

    Patterns and instances are scored in turn until the accepted patterns are
    those of an earlier turn: the same as in the last one, or, should scores
    swing, one of a round of sets.  A pattern is accepted with ``support``
    confident instances, so a small table may find none."""
    edges = stage(
        occurrences.groupBy("pattern", "instance").agg(F.max("mark").alias("mark")).withColumn("score", F.lit(None).cast("double")),
        "edges",
        occurrences.count(),
    )
    n = edges.count()
    # An instance with one seed or harmless occurrence is such an instance.
    state = stage(edges.groupBy("instance").agg(F.max(F.col("mark") * F.col("mark") * 2 + F.col("mark")).alias("m")), "marks", n)
    known = F.when(F.col("m") >= 3, F.lit(1.0)).when(F.col("m") == 1, F.lit(0.0))
    state = state.select("instance", known.alias("score"), (F.col("m") == 0).alias("open"))
    links = edges.select("pattern", "instance")
    earlier = set()
    while True:
        seen = links.join(state, "instance")
        patterns = stage(
            seen.filter("score IS NOT NULL")
            .groupBy("pattern")
            .agg(F.sum("score").alias("s"), F.count(F.lit(1)).alias("n"), F.sum((F.col("score") >= confident).cast("long")).alias("k"))
            .select("pattern", (F.col("s") / (F.col("n") + 1)).alias("confidence"), "k")
            .filter((F.col("confidence") >= confident) & (F.col("k") >= support)),
            "patterns",
            n,
        )
        hashed = F.xxhash64("pattern")
        accepted = patterns.agg(F.count("*"), F.bit_xor(hashed), F.sum(hashed.cast("decimal(38,0)"))).first()
        if tuple(accepted) in earlier:
            break
        earlier.add(tuple(accepted))
        best = links.join(patterns, "pattern").groupBy("instance").agg(F.max("confidence").alias("best"))
        state = stage(
            state.join(stage(best, "best", n), "instance", "left")
            .select("instance", F.when(F.col("open"), F.col("best")).otherwise(F.col("score")).alias("score"), "open"),
            "state",
            n,
        )
    return state.filter("open AND score IS NOT NULL").select("instance")


def _text_key():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, key, spans) of every row: spans are (kind, first, end) in code
    points, ordered by kind and start; ``key`` is a hash of the text.

    A null text is empty and has none; repeated rows each give a row; a null
    doc_id is an id like any other; ties of patterns need no order (the best
    confidence counts); other columns are ignored; an empty table gives an
    empty result."""
    keyed = docs.select(F.struct("doc_id", _text_key().alias("key")).alias("id"), "text")
    rows = stage(keyed.mapInArrow(over_texts(_rows, _OUT), _OUT_SQL), "pii")
    each = rows.select("doc_id", "key", F.explode("cands").alias("c")).select("doc_id", "key", "c.*")
    found = bootstrap(each.select("instance", "mark", F.explode("patterns").alias("pattern")))
    # All occurrences of a found instance have mark 0; given ones are not among the found.
    given = each.filter("mark = 2").select("instance").distinct()
    n = each.count()
    spans = (
        each.filter("mark >= 0 AND bare")
        .join(stage(found.union(given), "found", n), "instance")
        .groupBy(F.col("doc_id").alias("id"), F.col("key").alias("k"))
        .agg(F.array_sort(F.collect_set(F.struct(F.lit("id").alias("kind"), "first", "end"))).alias("more"))
    )
    return (
        rows.select("doc_id", "key", "base")
        .join(stage(spans, "spans", n), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("k")), "left")
        .select("doc_id", "key", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more")).alias("spans"))
    )


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["end"])), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """Counts and span digests per document, from ``personal_data``."""
    found = personal_data(docs)
    base = F.filter("spans", lambda s: s["kind"] != "id")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS if k != "id"],
        F.sha2(F.encode(_joined(base), "UTF-8"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        count("id"),
    )


def _masked(batches):
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            end, parts = 0, []
            for s in sorted(spans or [], key=lambda s: (s["first"], -s["end"])):
                if s["first"] >= end:
                    parts += [text[end : s["first"]], f"<{s['kind'].upper()}>"]
                end = max(end, s["end"])
            texts.append(None if text is None else "".join([*parts, text[end:]]))
        names = batch.schema.names[2:]
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *batch.columns[2:]], ["text", *names])


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; of
    overlapping spans the first in the text names the whole.  Rows and columns
    stay, in their order; ``n_chars``, if there, follows the text."""
    names = docs.columns
    one, key, marks, of = (free_name(docs, n) for n in ("_llm_id", "_llm_key", "_llm_spans", "_llm_of"))
    found = (
        personal_data(docs)
        .filter(F.size("spans") > 0)
        .select(F.col("doc_id").alias(one), F.col("key").alias(key), F.col("spans").alias(marks))
        .dropDuplicates([one, key])
    )
    keyed = docs.withColumn(of, _text_key())
    joined = keyed.join(found, F.col("doc_id").eqNullSafe(F.col(one)) & (F.col(of) == F.col(key)), "left")
    rest = [c for c in names if c != "text"]
    types = docs.select("text", *rest).schema
    masked = joined.select("text", marks, *rest).mapInArrow(_masked, types).select(*names)
    if "n_chars" in names:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked
