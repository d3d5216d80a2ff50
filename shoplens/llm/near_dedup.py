"""Near-duplicate documents by MinHash (operator 3).

A document is the set of its distinct word shingles.  *Fast similarity
sketching* fills ``bins`` minima: round i throws every shingle into one hashed
bin with a value in [i, i+1), and from round ``bins`` on round i throws all
shingles into bin i - bins, so every bin is full after 2 * bins rounds at the
latest; a large set stops after a round or two.  The fraction of equal bins
estimates the Jaccard similarity with the concentration of fully random
MinHash.  Bands of ``rows`` bins give bucket keys; candidates are verified on
the full shingle sets, and links become connected components.

Work per group: equal shingle sets are collapsed first (one class per set,
combined before the shuffle).  A bucket's members are not paired with each
other: they are tested against the member that shares most buckets (the
centre), then, where not yet connected, against a few members drawn anew for
each bucket while that finds links.

What is still apart is told apart by its differences from a *consensus* C, the
shingles that more than half of a sample of the group holds (any set would do;
a good one makes differences small).  Let x lack l(x) shingles of C and
L(x) be those, O(x) its shingles outside C, and p the percent.  Then

    |x & y| = |C| - l(x) - l(y) + |L(x) & L(y)| + |O(x) & O(y)|,

and x and y are alike if (100 + p) |x & y| >= p (|x| + |y|).  With
g(x) = (100 + p) l(x) + p |x| that is

    g(x) + g(y) <= (100 + p) (|C| + |L(x) & L(y)| + |O(x) & O(y)|).

  * Alike without sharing a difference: both are then alike to the member m of
    the least g, so links to m (a star) connect them.
  * Sharing lacked shingles only: members that lack the same ones are a class;
    with m(A) the member of least g of class A, x of A and y of B alike implies
    that x is alike to m(B), y to m(A) and m(A) to m(B), or, within a class, both
    to m(A).  So members meet the classes' least members, not each other, by a
    prefix join on lacked shingles that counts them in full.  Only members with
    (100 + p) |x & C| >= p (|x| + |y|) for some size of y come into it.
  * Sharing shingles outside C: a prefix join on those.

Only connections are kept, not all links, and the rows made follow the members
and the ways in which they differ, not the pairs.

Chance of missing a pair of similarity exactly 0.75 with 40 bands of 4 bins:
(1 - 0.75^4)^40 = 2.5e-7, less above; four bits of each minimum drop a pair at 0.75
with a chance of 1.2e-7.  Below 75 percent ``layout`` sets bands, rows and the
least number of equal bins anew for the same chances.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, over_texts, stage, take_over

BANDS, ROWS = 40, 4
BINS = BANDS * ROWS
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
np.seterr(over="ignore")  # 64-bit hashes wrap around
BITS = 4  # kept of each minimum, to compare two documents' sketches
#: Four bits agree in s + (1 - s) / 16 of the bins for similarity s; at 0.75
#: fewer than this many of 160 agree with a chance of 1.2e-7.
LEAST_EQUAL = 93
#: Chances of missing a pair of exactly the similarity asked for, by the bands
#: and by the sketch filter.
MISS_BANDS, MISS_FILTER = 2.6e-7, 1.2e-7
#: Most draws of centres, and centres of a draw, before members of one bucket
#: that are still apart are compared by their differences from a consensus.
TURNS, CENTRES = 1, 2
#: Members of a group, about, that its consensus is drawn from.
VOTERS = 64


def layout(percent: int) -> tuple[int, int, int]:
    """(bands, rows, least number of equal bins) for a least similarity: those
    above from 75 percent on; below, the most rows whose bands fit into as many
    bins, or one row and as many bands as it takes."""
    if not 1 <= percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    if percent >= 75:
        return BANDS, ROWS, LEAST_EQUAL
    s = percent / 100
    for rows in range(ROWS, 0, -1):
        bands = math.ceil(math.log(MISS_BANDS) / math.log1p(-(s**rows)))
        if rows == 1 or bands * rows <= BINS:
            return bands, rows, least_equal(s, bands * rows)


def least_equal(s: float, bins: int) -> int:
    """The most bins of which fewer agree with a chance of at most ``MISS_FILTER``."""
    p = s + (1 - s) / 2**BITS
    below = 0.0
    for k in range(bins + 1):
        ways = math.lgamma(bins + 1) - math.lgamma(k + 1) - math.lgamma(bins - k + 1)
        below += math.exp(ways + k * math.log(p) + (bins - k) * math.log1p(-p))
        if below > MISS_FILTER:
            return k
    return bins


def mix(x: np.ndarray) -> np.ndarray:
    """A strong 64-bit mixer (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """64-bit hashes of words, kept while a worker meets the same words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 40:
            self[word] = value
        return value


@lru_cache(maxsize=1)
def _words() -> _Words:
    return _Words()


def shingles(text: str, width: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``width``-word shingles.

    A-Z are lowered; words are runs without ASCII white space.  Fewer words
    than ``width``: the whole sequence is one shingle; no words: none.
    Unlike shingles share a hash with a chance of 2^-64."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array(list(map(_words().__getitem__, words)), np.uint64)
    n = min(width, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = mix((out * _STEP) ^ h[i : len(h) - n + 1 + i])
    return np.unique(out)


def sketch(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Fast similarity sketch of a non-empty set of 64-bit hashes: for each bin
    the least (round, value) that landed there, as one integer."""
    empty = np.iinfo(np.uint64).max
    out = np.full(bins, empty, np.uint64)
    low, high = np.uint64((1 << 52) - 1), np.uint64(52)
    # A later round never displaces an earlier one's entry, so small sets take
    # as many rounds at once as usually fill the bins.
    step = min(bins, max(1, 6 * bins // len(values)))
    for first in range(0, bins, step):
        turns = np.arange(first, min(bins, first + step), dtype=np.uint64)[:, None]
        h = mix(values + _STEP * (turns + np.uint64(1)))
        at = ((h >> high) * np.uint64(bins)) >> np.uint64(12)
        np.minimum.at(out, at.ravel().astype(np.int64), ((turns << high) | (h & low)).ravel())
        if (out < empty).all():
            return out
    left = np.flatnonzero(out == empty)
    turns = (left + bins).astype(np.uint64)[:, None]
    out[left] = ((turns << high) | (mix(values + _STEP * (turns + np.uint64(1))) & low)).min(axis=1)
    return out


def band_keys(mins: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = mins.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64) * _STEP
    for i in range(rows.shape[1]):
        key = mix(key ^ rows[:, i]) + _STEP
    return key.view(np.int64)


def planes(mins: np.ndarray) -> list[int]:
    """``BITS`` bits of each bin's minimum as bit planes, 64 bins to an integer."""
    h = mix(mins)
    out = []
    for k in range(BITS):
        bits = np.zeros(-(-len(mins) // 64) * 64, np.uint8)
        bits[: len(mins)] = (h >> np.uint64(63 - k)).astype(np.uint8) & 1
        out += np.packbits(bits).view(">i8").astype(np.int64).tolist()
    return out


def _planes(bins: int) -> list[str]:
    return [f"b{k}" for k in range(BITS * -(-bins // 64))]


def _sketch_schema(bins: int) -> tuple[pa.Schema, str]:
    names = _planes(bins)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())]
        + [(c, pa.int64()) for c in names]
        + [("bands", pa.list_(pa.int64()))]
    )
    return schema, f"doc_id bigint, n bigint, digest binary, {', '.join(f'{c} bigint' for c in names)}, bands array<bigint>"


def _sketch_rows(width: int, bands: int, bins: int):
    names = _planes(bins)

    def rows(ids: list, texts: list[str]) -> dict[str, list]:
        take_over("shingles", _words.cache_clear)
        out = {c: [] for c in ("doc_id", "n", "digest", *names, "bands")}
        for i, text in zip(ids, texts, strict=True):
            values = shingles(text, width)
            out["doc_id"].append(i)
            out["n"].append(len(values))
            out["digest"].append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
            if len(values):
                mins = sketch(values, bins)
                bits, keys = planes(mins), band_keys(mins, bands)
            else:
                bits, keys = [0] * len(names), []
            for name, x in zip(names, bits, strict=True):
                out[name].append(x)
            out["bands"].append(keys)
        return out

    return rows


def _set_rows(width: int):
    def rows(ids: list, texts: list[str]) -> dict[str, list]:
        take_over("shingles", _words.cache_clear)
        return {"id": ids, "set": [shingles(t, width).tobytes() for t in texts]}

    return rows


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])

    return run


_DIFFERENT_SQL = (
    "grp bigint, rep bigint, comp bigint, n bigint, nc bigint, k bigint, spare bigint, own binary, lack array<bigint>, "
    "extra array<bigint>"
)


def _different(percent: int):
    """Of (grp, rep, comp, least, set, consensus): sizes n of the set and nc of
    the consensus, the k shingles they share, and how many of the consensus an
    alike partner and x may lack together (``spare``), if they share no other; a
    digest of the lacked ones; the lacked ones, if a partner of at least ``least`` shingles can be alike by
    shared ones of the consensus alone; and of those outside, in order of their
    hashes, as many as such a partner must share one of."""

    def run(batches):
        for batch in batches:
            columns = [[] for _ in range(7)]
            for least, x, c in zip(*(batch.column(i) for i in (3, 4, 5)), strict=True):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                c = np.sort(c.values.to_numpy(zero_copy_only=False).view(np.uint64))
                lack, extra = np.setdiff1d(c, x, assume_unique=True), np.setdiff1d(x, c, assume_unique=True)
                n, nc, k = len(x), len(c), len(x) - len(extra)
                partner = max(least.as_py(), -(-n * percent // 100))
                share = -(-percent * (n + partner) // (100 + percent))  # of x, at least
                outside = max(1, share - k)  # of those, outside the consensus, at least
                some_extra = extra[: max(0, len(extra) - outside + 1)]
                some_lack = lack if share <= k else lack[:0]
                digest = hashlib.blake2b(lack.tobytes(), digest_size=16).digest()
                values = (n, nc, k, nc - share, digest, some_lack.view(np.int64), some_extra.view(np.int64))
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            types = [pa.int64()] * 4 + [pa.binary()] + [pa.list_(pa.int64())] * 2
            made = [pa.array(v, t) for v, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *made], ["grp", "rep", "comp", "n", "nc", "k", "spare", "own", "lack", "extra"]
            )

    return run


def _tokens(batches):
    """(grp, set) -> (grp, tokens): the set as an array."""
    for batch in batches:
        sets = [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["grp", "tokens"])


def _alike(percent: int, bins: int, least: int):
    """Pairs whose sizes and sketches allow the similarity."""
    names = _planes(bins)
    words = len(names) // BITS
    equal = F.lit(0)
    for i in range(words):
        differ = F.lit(0).cast("bigint")
        for k in range(BITS):
            c = names[k * words + i]
            differ = differ.bitwiseOR(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}")))
        equal = equal + 64 - F.bit_count(differ)
    spare = 64 * words - bins  # bins past the sketch are equal in all
    small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    return (small * 100 >= large * percent) & (equal - spare >= least)


def _pair(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def drawn_pairs(rows: DataFrame, traits: DataFrame, turn: int, alike) -> DataFrame:
    """Of (key, rep, comp): members with ``CENTRES`` of their bucket, drawn anew
    every turn, of another component.  Sizes and sketches (``traits``) are
    compared on the bucket's rows, so pairs that cannot be links are not made."""
    fields = [c for c in traits.columns if c != "id"]
    each = rows.join(traits, F.col("rep") == F.col("id")).select("key", F.struct("rep", "comp", *fields).alias("x"))
    drawn = [F.min_by("x", F.xxhash64("x.rep", "key", F.lit(turn), F.lit(i))) for i in range(CENTRES)]
    centres = each.groupBy("key").agg(F.array_distinct(F.array(*drawn)).alias("centres"))
    both = each.join(centres, "key").select("x", F.explode("centres").alias("y"))
    return both.filter("x.comp <> y.comp").filter(alike).select(*_pair(F.col("x.rep"), F.col("y.rep")))


def outside_pairs(rows: DataFrame, traits: DataFrame, alike) -> DataFrame:
    """Of (grp, rep, comp, extra): members of two components that share a shingle
    outside the consensus.  Sizes and sketches (``traits``) are compared in the
    join, so only pairs that may be links leave it."""
    each = rows.select("grp", "rep", "comp", F.explode("extra").alias("token"))
    often = each.groupBy("grp", "token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
    each = each.join(often.select("grp", "token"), ["grp", "token"], "left_semi")
    each = stage(each.join(traits, F.col("rep") == F.col("id")).drop("id"), "outside")
    x, y = each.alias("x"), each.alias("y")
    fits = (
        (F.col("x.grp") == F.col("y.grp"))
        & (F.col("x.token") == F.col("y.token"))
        & (F.col("x.rep") < F.col("y.rep"))
        & (F.col("x.comp") != F.col("y.comp"))
        & alike
    )
    return x.join(y, fits).select(*_pair(F.col("x.rep"), F.col("y.rep")))


def joined_components(found: DataFrame, new: DataFrame) -> DataFrame:
    """``found`` (node, component) after the links ``new`` (a, b): only the
    components that they touch are a graph, not all links once more."""
    own = new.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    nodes = found.unionByName(own.withColumn("component", F.col("node"))).groupBy("node").agg(F.min("component").alias("component"))
    n = found.count() + 2 * new.count()
    nodes = stage(nodes, "nodes", n)
    a, b = (nodes.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in "ab")
    met = components(new.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    met = met.select(F.col("node").alias("component"), F.col("component").alias("least"))
    return stage(nodes.join(met, "component", "left").select("node", F.coalesce("least", "component").alias("component")), "joined", n)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents link when 100 * intersection >= percent * union of their shingle
    sets; component_id is the smallest doc_id reachable.  A null or wordless
    text has no shingles and links with nothing.  Repeated rows keep one result
    row each and share a class; rows of one doc_id with unlike texts count as
    linked through that id.  A null doc_id links with nothing: its component_id
    is null and kept false.  Other columns are ignored; an empty table gives an
    empty result."""
    bands, per_band, least_bins = layout(percent)
    bins = bands * per_band
    schema, schema_sql = _sketch_schema(bins)
    sketches = stage(
        docs.select("doc_id", "text").mapInArrow(
            over_texts(_sketch_rows(width, bands, bins), schema),
            schema_sql,
        ),
        "sketches",
    )
    real = sketches.filter("doc_id IS NOT NULL AND n > 0")
    # One class per shingle set, named by its smallest doc_id.
    member = real.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = stage(
        real.join(member.withColumnRenamed("rep", "doc_id"), ["digest", "doc_id"], "left_semi")
        .withColumnRenamed("doc_id", "rep")
        .dropDuplicates(["rep", "digest"]),
        "classes",
    )
    # One id with unlike texts: two classes of one name, joined by it.
    traits = classes.select(F.col("rep").alias("id"), "n", *_planes(bins))
    banded = classes.select("rep", F.explode("bands").alias("key"))
    shared = stage(
        banded.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.count("*").alias("size"))
        .filter("lo < hi"),
        "shared",
    )
    members = stage(banded.join(shared.select("key", "size"), "key"), "members")
    met = members.groupBy("rep").agg(F.sum("size").alias("met"))
    n_members = members.count()
    heads = stage(
        members.join(met, "rep").groupBy("key").agg(F.max_by("rep", F.struct("met", -F.col("rep"))).alias("centre")),
        "heads",
        n_members,
    )
    buckets = stage(members.select("key", "rep").join(heads, "key"), "buckets", n_members)

    involved = buckets.select("rep").distinct()
    sets = stage(
        docs.join(involved, F.col("doc_id") == F.col("rep"), "left_semi")
        .select("doc_id", "text")
        .mapInArrow(
            over_texts(_set_rows(width), pa.schema([("id", pa.int64()), ("set", pa.binary())])), "id bigint, set binary"
        )
        .filter(F.length("set") > 0)
        .dropDuplicates(["id", "set"]),
        "sets",
    )

    def verified(pairs: DataFrame) -> DataFrame:
        """Of the candidate pairs (a, b), a < b, those that are links."""
        x = traits.alias("x")
        y = traits.alias("y")
        fit = (
            pairs.distinct()
            .join(x, F.col("a") == F.col("x.id"))
            .join(y, F.col("b") == F.col("y.id"))
            .filter(alike)
            .select("a", "b")
            .distinct()
        )
        both = (
            fit.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
            .join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
            .select("a", "b", "sa", "sb")
        )
        return stage(both.mapInArrow(_verify(percent), "a bigint, b bigint"), "links")

    def named(rows: DataFrame, found: DataFrame) -> DataFrame:
        """Bucket rows with the component so far."""
        comp = found.withColumnRenamed("node", "rep")
        return rows.select("key", "rep").join(comp, "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("comp"))

    def mixed(rows: DataFrame) -> DataFrame:
        """Rows of the buckets that hold more than one component."""
        open_keys = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
        return stage(rows.join(open_keys.select("key"), "key", "left_semi"), "mixed", n_members)

    def consensus(rows: DataFrame) -> DataFrame:
        """(grp, least, consensus) of the groups with more than one component."""
        size = rows.groupBy("grp").agg(
            F.count("*").alias("size"), F.min("n").alias("least"), F.min("comp").alias("lo"), F.max("comp").alias("hi")
        )
        size = stage(size.filter("lo < hi").select("grp", "size", "least"), "groups")
        voters = rows.join(size, "grp").filter(
            (F.col("rep") == F.col("grp")) | (F.pmod(F.xxhash64("rep", "grp"), F.ceil(F.col("size") / VOTERS)) == 0)
        )
        ballots = voters.select("grp", "rep").join(sets, F.col("rep") == F.col("id")).select("grp", "set")
        ballots = stage(ballots.mapInArrow(_tokens, "grp bigint, tokens array<bigint>"), "ballots")
        n = ballots.groupBy("grp").agg(F.count("*").alias("voters"))
        held = ballots.select("grp", F.explode("tokens").alias("token")).groupBy("grp", "token").agg(F.count("*").alias("votes"))
        # fewer than twice the shingles of a voter
        chosen = held.join(n, "grp").filter("2 * votes > voters").groupBy("grp").agg(F.collect_list("token").alias("consensus"))
        nothing = F.array().cast("array<bigint>")
        return stage(size.join(chosen, "grp", "left").select("grp", "least", F.coalesce("consensus", nothing).alias("consensus")), "consensus")

    def differences(rows: DataFrame) -> DataFrame:
        own = sets.select(F.col("id").alias("rep"), "set")
        both = rows.join(consensus(rows), "grp").join(own, "rep").select("grp", "rep", "comp", "least", "set", "consensus")
        made = both.mapInArrow(_different(percent), _DIFFERENT_SQL)
        whole = 100 + percent
        return stage(made.withColumn("g", whole * (F.col("nc") - F.col("k")) + percent * F.col("n")), "differences")

    def stars(rows: DataFrame) -> DataFrame:
        """Links to the least member of the group, and of those lacking the same."""
        whole, least = 100 + percent, F.min(F.struct("g", "rep", "comp"))
        groups = rows.groupBy("grp").agg(least.alias("m"))
        near = rows.join(groups, "grp").filter(F.col("g") + F.col("m.g") <= whole * F.col("nc"))
        classes = rows.groupBy("grp", "own").agg(least.alias("m"))
        same = rows.join(classes, ["grp", "own"]).filter(F.col("g") + F.col("m.g") <= whole * (2 * F.col("nc") - F.col("k")))
        return near.unionByName(same).filter("comp <> m.comp").select(*_pair(F.col("rep"), F.col("m.rep"))).distinct()

    def lacking_alike(rows: DataFrame) -> DataFrame:
        """Links of members and least members of classes by what both lack.

        Of two that lack l >= m shingles, together not more than ``spare``
        different ones, the one that lacks fewer shares one of its first
        spare - m + 1; the lists are short, so the join counts in full."""
        each = rows.filter(F.size("lack") > 0).withColumn("l", F.size("lack")).select("grp", "rep", "comp", "g", "nc", "l", "spare", "own", "lack")
        heads = each.groupBy("grp", "own").agg(F.min(F.struct("g", "rep", "comp", "nc", "l", "spare", "lack")).alias("m"))
        heads = heads.select("grp", "m.*")
        first = F.least(F.col("l"), F.col("spare") - F.col("l") + 1).cast("int")

        def all_of(side):
            return side.withColumn("token", F.explode("lack"))

        def first_of(side):
            return side.filter(first > 0).withColumn("token", F.explode(F.slice("lack", F.lit(1), first)))

        def joined(large, small, order):
            both = F.array_intersect("x.lack", "y.lack")
            fits = (
                (F.col("x.grp") == F.col("y.grp"))
                & (F.col("x.token") == F.col("y.token"))
                & (F.col("x.comp") != F.col("y.comp"))
                & order
                & (F.col("x.g") + F.col("y.g") <= (100 + percent) * (F.col("x.nc") + F.size(both)))
                & (F.element_at(both, 1) == F.col("x.token"))  # a pair once
            )
            return large.alias("x").join(small.alias("y"), fits).select(*_pair("x.rep", "y.rep"))

        fewer = joined(all_of(each), first_of(heads), F.col("x.l") >= F.col("y.l"))
        return fewer.unionByName(joined(all_of(heads), first_of(each), F.col("x.l") > F.col("y.l")))

    alike = _alike(percent, bins, least_bins)
    met = verified(buckets.filter("rep <> centre").select(*_pair(F.col("rep"), F.col("centre"))))
    n_links = met.count()
    found = stage(components(met, n_links), "found", 2 * n_links)
    rest = mixed(named(buckets, found))
    for turn in range(TURNS):
        if rest.isEmpty():
            break
        new = verified(drawn_pairs(rest, traits, turn, alike))
        if new.isEmpty():
            break
        found = joined_components(found, new)
        rest = mixed(named(rest, found))
    if not rest.isEmpty():
        n_classes = classes.count()
        sizes = traits.groupBy("id").agg(F.min("n").alias("n"))
        rows = rest.join(heads, "key").select(F.col("centre").alias("grp"), "rep", "comp").distinct()
        rows = stage(rows.join(sizes, F.col("rep") == F.col("id")).select("grp", "rep", "comp", "n"), "rest", n_classes + n_members)
        made = differences(rows)
        new = stars(made).union(lacking_alike(made)).union(verified(outside_pairs(made, traits, alike)))
        new = stage(new.distinct(), "new")
        if not new.isEmpty():
            found = joined_components(found, new)

    named_class = member.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("digest").alias("of"), F.coalesce("component", "rep").alias("component_id")
    )
    named_class = stage(named_class, "named", sketches.count())
    alone = F.col("n") == 0
    return (
        sketches.select("doc_id", "n", "digest")
        .join(named_class, (F.col("digest") == F.col("of")) & ~alone & F.col("doc_id").isNotNull(), "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )
