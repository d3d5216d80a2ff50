"""Hot keys: one session / user / category / product holds a third of all
rows.  Results are checked against brute force (plain Python over the same
small fixture), so the skew-safe plans are shown to stay exact."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from shoplens.operators.city_share import city_share
from shoplens.operators.sequence import consecutive_pairs, transition_counts, transitions
from shoplens.operators.topk import top_k_per_group
from shoplens.plans import ads as A
from shoplens.plans import page_jump as Q3

N = 6000


def _actions(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(N):
        hot = i % 3 == 0
        session = "hot" if hot else f"s{rnd.randrange(300)}"
        # the hot session spans ~20 days of hours; others a few hours
        sec = rnd.randrange(20 * 86400) if hot else rnd.randrange(5 * 3600)
        t = f"2024-01-{1 + sec // 86400:02d} {sec % 86400 // 3600:02d}:{sec % 3600 // 60:02d}:{sec % 60:02d}"
        rows.append((session, t, i, rnd.randrange(1, 8)))
    return rows, spark.createDataFrame(rows, "session_id string, action_time string, event_id long, page_id long")


def test_transitions_with_a_hot_session(spark):
    rows, df = _actions(spark)
    by_session = collections.defaultdict(list)
    for s, t, e, p in rows:
        by_session[s].append((t, e, p))
    want = collections.Counter()
    for items in by_session.values():
        items.sort()
        pages = [p for _, _, p in items]
        for a, b in zip(pages, pages[1:] + [None]):
            want[(a, b)] += 1
    got = Q3.page_transition_counts(df).collect()
    assert {(r.frm, r.nxt): r.c for r in got} == dict(want)
    # every transition by itself, whatever the partitions
    for n in (1, 3, 64):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            t = transitions(df, "session_id", ["action_time", "event_id"], "page_id")
            rows = t.groupBy("frm", "nxt").count().collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
        assert {(r.frm, r.nxt): r["count"] for r in rows} == dict(want)


def test_transitions_of_null_groups_values_and_no_rows(spark):
    rows = [(None, 1, "a"), (None, 2, "b"), ("x", 1, "a"), ("x", 2, None), ("x", 3, "c"), ("", 1, "d")]
    schema = "g string, o int, v string"
    df = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, transitions(df, "g", ["o"], "v").collect()), key=repr)
    want = [(None, "a", "b"), (None, "b", None), ("x", "a", None), ("x", None, "c"), ("x", "c", None), ("", "d", None)]
    assert got == sorted(want, key=repr)
    pairs = sorted(map(tuple, consecutive_pairs(df, "g", ["o"], "v").collect()), key=repr)
    assert pairs == sorted([(None, "a", "b"), ("x", "a", None), ("x", None, "c")], key=repr)
    empty = spark.createDataFrame([], schema)
    assert transitions(empty, "g", ["o"], "v").count() == 0
    assert transition_counts(empty, "g", ["o"], "v").count() == 0


def test_pairs_take_one_shuffle_of_the_actions(spark):
    """What is checkpointed reads the actions through one range exchange, and
    what follows shuffles the partitions' sums and ends only."""
    _, df = _actions(spark)
    seen = []
    plain = type(df).checkpoint

    def checkpoint(self, *a, **k):
        seen.append(self._jdf.queryExecution().optimizedPlan().toString())
        return plain(self, *a, **k)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(df), "checkpoint", checkpoint)
        out = Q3.page_transition_counts(df)
    assert len(seen) == 1 and seen[0].count("RepartitionByExpression") == 1 and "Window" not in seen[0]
    assert "action_time" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_page_jump_ratio_brute_force(spark):
    rows, df = _actions(spark)
    by_session = collections.defaultdict(list)
    for s, t, e, p in rows:
        by_session[s].append((t, e, p))
    pairs, visits = collections.Counter(), collections.Counter(p for *_, p in rows)
    for items in by_session.values():
        items.sort()
        pages = [p for _, _, p in items]
        pairs.update(zip(pages, pages[1:]))
    flow = ["1", "2", "3", "4"]
    want = {f"{a}-{b}": pairs[(a, b)] / visits[a] for a, b in [(1, 2), (2, 3), (3, 4)] if pairs[(a, b)]}
    got = {r.jump: r.ratio for r in Q3.page_jump_ratio(df, flow).collect()}
    assert got == want


def test_top_k_with_a_hot_group(spark):
    rnd = random.Random(5)
    rows = [("hot" if i % 3 == 0 else f"g{rnd.randrange(50)}", f"k{i}", rnd.randrange(1000)) for i in range(N)]
    df = spark.createDataFrame(rows, "g string, k string, v long")
    got = top_k_per_group(df, ["g"], [F.desc("v"), "k"], 5).collect()
    want = []
    by = collections.defaultdict(list)
    for g, k, v in rows:
        by[g].append((-v, k))
    for g, items in by.items():
        want += [(g, k, -nv) for nv, k in sorted(items)[:5]]
    assert sorted(map(tuple, got)) == sorted(want)


def test_city_share_with_a_hot_product(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(N):
        product = "hot" if i % 3 == 0 else f"p{rnd.randrange(40)}"
        rows.append(("A", product, f"c{min(rnd.randrange(12), rnd.randrange(12))}"))
    df = spark.createDataFrame(rows, "area string, product_name string, city_name string")
    got = {r.product_name: (r.product_count, r.city_click_ratio)
           for r in city_share(df, ["area", "product_name"], "city_name").collect()}
    by = collections.defaultdict(collections.Counter)
    for _, p, c in rows:
        by[p][c] += 1
    for p, cnt in by.items():
        total = sum(cnt.values())
        top = sorted(cnt.items(), key=lambda x: (-x[1], x[0]))[:2]
        shares = [int(n * 1000 / total + 0.5) / 10 for _, n in top]
        rest = 100.0
        for s in shares:
            rest -= s
        text = ",".join(f"{c}:{s}%" for (c, _), s in zip(top, shares)) + f",其它：{int(rest * 10 + 0.5) / 10}%"
        assert got[p] == (total, text), p


def test_ban_list_with_a_hot_user(spark):
    rnd = random.Random(9)
    t0 = 1704067200000
    rows = []
    for i in range(N):
        user = "hot" if i % 3 == 0 else f"u{rnd.randrange(500)}"
        rows.append((t0 + rnd.randrange(10 * 86400000), "A", "c", user, str(rnd.randrange(3))))
    ads = spark.createDataFrame(rows, "timestamp long, area string, city string, userid string, adid string")
    kept = A.ads_after_ban(ads, threshold=3)
    # brute force: first day with >= 3 clicks on one ad; keep that day and before
    per = collections.Counter()
    for ms, _, _, u, ad in rows:
        per[(u, (ms - t0) // 86400000, ad)] += 1
    ban_day = {}
    for (u, d, _), n in per.items():
        if n >= 3:
            ban_day[u] = min(ban_day.get(u, d), d)
    want = sum(1 for ms, _, _, u, _ in rows if u not in ban_day or (ms - t0) // 86400000 <= ban_day[u])
    assert kept.count() == want
    assert "hot" in ban_day


def test_hot_session_within_one_second(spark):
    """All of the hot session's rows share one timestamp: only the row split
    divides it, and the result stays exact (order by event id)."""
    rnd = random.Random(2)
    rows = [("hot", "2024-01-01 00:00:00", i, rnd.randrange(1, 6)) for i in range(3000)]
    rows += [(f"s{i % 50}", f"2024-01-01 00:{i % 60:02d}:00", 10_000 + i, rnd.randrange(1, 6)) for i in range(3000)]
    df = spark.createDataFrame(rows, "session_id string, action_time string, event_id long, page_id long")
    by_session = collections.defaultdict(list)
    for s, t, e, p in rows:
        by_session[s].append((t, e, p))
    want = collections.Counter()
    for items in by_session.values():
        items.sort()
        pages = [p for _, _, p in items]
        for a, b in zip(pages, pages[1:] + [None]):
            want[(a, b)] += 1
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        ranged = df.repartitionByRange(16, "session_id", "action_time", "event_id")
        parts = {r.p for r in ranged.filter("session_id = 'hot'").select(F.spark_partition_id().alias("p")).collect()}
        assert len(parts) > 1  # the hot session is split over several tasks
        got = Q3.page_transition_counts(df).collect()
        assert {(r.frm, r.nxt): r.c for r in got} == dict(want)
        # exact even when Spark does not share the range shuffle between branches
        spark.conf.set("spark.sql.exchange.reuse", "false")
        got = Q3.page_transition_counts(df).collect()
        assert {(r.frm, r.nxt): r.c for r in got} == dict(want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.exchange.reuse", "true")
