"""Job-level cases on hand-written rows (FIXTURES §3) and properties."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplens.operators.sequence import consecutive_pairs
from shoplens.operators.topk import top_k_per_group
from shoplens.plans import ads as A
from shoplens.plans import category as Q12
from shoplens.plans import page_jump as Q3
from shoplens.sources import schemas

UVA_DDL = (
    "date string, user_id long, session_id string, page_id long, action_time string, search_keyword string, "
    "click_category_id long, click_product_id long, order_category_ids string, order_product_ids string, "
    "pay_category_ids string, pay_product_ids string, city_id long, event_id long"
)


def _action(i, session, page, t, click=-1, orders=None, pays=None):
    return ("2024-01-01", 1, session, page, t, None, click, click, orders, orders, pays, pays, 1, i)


def test_rank_ties(spark):
    df = spark.createDataFrame([("a", f"p{i}", c) for i, c in enumerate([191, 188, 185, 184, 184])],
                               "area string, p string, ct long")
    w = Window.partitionBy("area").orderBy(F.desc("ct"))
    assert [r.rk for r in df.withColumn("rk", F.rank().over(w)).orderBy(F.desc("ct"), "p").collect()] == [1, 2, 3, 4, 4]
    df2 = spark.createDataFrame([("a", f"p{i}", c) for i, c in enumerate([9, 8, 7, 7, 6])], "area string, p string, ct long")
    assert top_k_per_group(df2, ["area"], [F.desc("ct")], 3, with_ties=True).count() == 4
    assert top_k_per_group(df2, ["area"], [F.desc("ct"), "p"], 3).count() == 3


def test_page_pairs_and_breaks(spark):
    pages = [1, 5, 6, 18, 2, 7]
    rows = [_action(i, "s1", p, f"2024-01-01 00:00:{i:02d}") for i, p in enumerate(pages)]
    acts = spark.createDataFrame(rows, UVA_DDL)
    pairs = {(r.frm, r.nxt) for r in Q3.session_page_pairs(acts).collect()}
    assert pairs == {(1, 5), (5, 6), (6, 18), (18, 2), (2, 7)}
    got = {r.jump: r.c for r in Q3.page_jump_count(acts, ["1", "5", "6"]).collect()}
    assert got == {"1-5": 1, "5-6": 1}
    # an off-flow page between breaks the jump; the from-page still counts
    rows = [_action(i, "s2", p, f"2024-01-01 00:00:0{i}") for i, p in enumerate([1, 9, 2])]
    acts = spark.createDataFrame(rows, UVA_DDL)
    assert Q3.page_jump_ratio(acts, ["1", "2"]).count() == 0
    assert {r.page_id: r.n for r in Q3.page_visit_count(acts, ["1"]).collect()} == {1: 1}


def test_equal_times_use_event_id(spark):
    rows = [_action(i, "s", p, "2024-01-01 00:00:00") for i, p in zip([3, 1, 2], [30, 10, 20])]
    acts = spark.createDataFrame(rows, UVA_DDL)
    assert {(r.frm, r.nxt) for r in Q3.session_page_pairs(acts).collect()} == {(10, 20), (20, 30)}


def test_consecutive_pairs_match_plain_lead(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        s = f"s{rnd.randrange(20)}"
        rows.append((s, rnd.randrange(5000), i, rnd.randrange(50)))
    df = spark.createDataFrame(rows, "sid string, t long, eid long, page long")
    got = consecutive_pairs(df, "sid", ["t", "eid"], "page")
    w = Window.partitionBy("sid").orderBy("t", "eid")
    want = (
        df.select("sid", F.col("page").alias("frm"), F.lead("page").over(w).alias("nxt"))
        .filter("nxt IS NOT NULL")
    )
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_classifier_precedence_and_order(spark):
    rows = [
        _action(0, "s", 1, "t", click=3, orders="4,5"),   # click of 3 only
        _action(1, "s", 1, "t", orders="7,8,"),           # trailing comma: 7 and 8
        _action(2, "s", 1, "t", orders="7", pays="9"),    # order wins over pay
        _action(3, "s", 1, "t", pays=""),                 # empty list: nothing
    ]
    acts = spark.createDataFrame(rows, UVA_DDL)
    got = {r.category_id: (r.click_count, r.order_count, r.pay_count) for r in Q12.category_counts(acts).collect()}
    assert got == {"3": (1, 0, 0), "7": (0, 2, 0), "8": (0, 1, 0)}


def test_three_key_order(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, 5), ("b", 0, 2, 5), ("c", 0, 0, 6)],
        "category_id string, click_count long, order_count long, pay_count long",
    )
    from shoplens.operators.topk import top_k

    top = top_k(df, [F.desc("pay_count"), F.desc("order_count"), F.desc("click_count"), "category_id"], 10)
    assert [r.category_id for r in top.collect()] == ["c", "b", "a"]


def test_ads_line_parse(spark):
    lines = spark.createDataFrame([("1577000000000 华北 北京 3 2",)], "value string")
    r = A.parse_ads_lines(lines).first()
    assert (r.timestamp, r.area, r.city, r.userid, r.adid) == (1577000000000, "华北", "北京", "3", "2")
    bad = spark.createDataFrame([("x 华北",)], "value string")
    r = A.parse_ads_lines(bad, lenient=True).first()
    assert r.valid is False and r.timestamp is None


def test_ban_batch_form(spark):
    # threshold 3; day 1: 3 clicks of u on ad a -> banned; day 2 dropped.
    day1, day2 = 1704067200000, 1704153600000
    rows = [(day1 + i, "A", "c", "u", "a") for i in range(3)] + [(day2, "A", "c", "u", "b")]
    rows += [(day1, "A", "c", "v", "a"), (day1 + 1, "A", "c", "v", "a"), (day2, "A", "c", "v", "a"), (day2 + 1, "A", "c", "v", "a")]
    ads = spark.createDataFrame(rows, schemas.ADS_LOG)
    bans = {r.userid: r.ban_date for r in A.ban_list(ads, 3).collect()}
    assert bans == {"u": "2024-01-01"}          # v: 2 + 2 on different days -> not banned
    kept = A.ads_after_ban(ads, 3)
    assert kept.filter("userid = 'u'").count() == 3 and kept.filter("userid = 'v'").count() == 4


def test_top_ads_json(spark):
    counts = spark.createDataFrame(
        [("d", "A", "c1", "2", 700), ("d", "A", "c2", "2", 500), ("d", "A", "c1", "9", 1100), ("d", "A", "c1", "1", 5),
         ("d", "A", "c1", "3", 5)],
        "date string, area string, city string, adid string, cnt long",
    )
    r = A.date_area_top_ads(counts).first()
    assert r.top3 == '[{"2":1200},{"9":1100},{"1":5}]'


def test_schema_enforcement(spark):
    df = spark.createDataFrame([("1", "x", "u", "30", "F")], "user_id string, username string, name string, age string, gender string")
    df = df.withColumn("professional", F.lit("p"))
    out = schemas.enforce(df, schemas.USER_INFO)
    assert out.dtypes[:4] == [("user_id", "bigint"), ("username", "string"), ("name", "string"), ("age", "int")]


def test_window_labels_merge_days(spark):
    # A window longer than a day merges equal HH:mm labels of different days
    day = 86_400_000
    t = 1704067200000 + 12 * 3_600_000  # 2024-01-01 12:00 UTC
    rows = [(t, "A", "c", "u", "1"), (t + day, "A", "c", "u", "1"), (t + day + 60_000, "A", "c", "u", "1")]
    ads = spark.createDataFrame(rows, schemas.ADS_LOG)
    got = {(r.adid, r.hhmm): r.cnt for r in A.last_window_ad_clicks(ads, window_minutes=2 * 24 * 60).collect()}
    assert got == {("1", "12:00"): 2, ("1", "12:01"): 1}
    got = {(r.adid, r.hhmm): r.cnt for r in A.last_window_ad_clicks(ads, window_minutes=60).collect()}
    assert got == {("1", "12:00"): 1, ("1", "12:01"): 1}
    j = A.last_window_ad_clicks_json(ads, window_minutes=60).first()
    assert (j.adid, j.minutes) == ("1", '[{"12:00":1},{"12:01":1}]')


def test_top_category_without_clicks_has_no_sessions(spark):
    # K2: category 9 is top by orders but never clicked
    rows = [_action(0, "s1", 1, "t", orders="9"), _action(1, "s1", 1, "t", click=3)]
    acts = spark.createDataFrame(rows, UVA_DDL)
    assert {r.category_id for r in Q12.category_top10(acts).collect()} == {"9", "3"}
    assert {(r.category_id, r.session_id) for r in Q12.category_session_top10(acts).collect()} == {("3", "s1")}


def test_strict_parse_fails_on_malformed_lines(spark):
    # A short line or a bad timestamp fails the job in strict mode
    import pytest

    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            for line in ("notanumber A c u 1", "1577000000000 A c"):
                bad = spark.createDataFrame([(line,)], "value string")
                with pytest.raises(Exception, match="malformed ad-click line"):
                    A.parse_ads_lines(bad).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_top_ads_as_object(spark):
    counts = spark.createDataFrame([("d", "A", "c", "2", 1200), ("d", "A", "c", "9", 1100)],
                                   "date string, area string, city string, adid string, cnt long")
    assert A.date_area_top_ads(counts, as_object=True).first().top3 == '{"2":1200,"9":1100}'
