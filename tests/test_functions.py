"""Column helpers and small operators on hand-written rows (FIXTURES §3)."""

from pyspark.sql import functions as F

from shoplens.functions import columns as C
from shoplens.operators.city_share import city_share, register_city_ratio_function
from shoplens.operators.sequence import flow_pairs
from shoplens.params import Conditions, parse_lenient_json


def _one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_java_split_semantics(spark):
    # Java String.split drops trailing empty parts; "" gives one empty part.
    assert _one(spark, C.split_like_java("s", ","), "1,2,") == ["1", "2"]
    assert _one(spark, C.split_like_java("s", ","), "1,,2") == ["1", "", "2"]
    assert _one(spark, C.split_like_java("s", ","), "") == [""]
    assert _one(spark, C.split_like_java("s", ","), ",,,") == []
    assert _one(spark, C.split_like_java("s", " "), "a b ") == ["a", "b"]
    assert _one(spark, C.id_list("s"), "1,2,") == ["1", "2"]
    assert _one(spark, C.id_list("s"), "") == []
    assert _one(spark, C.words("s"), "a  b") == ["a", "", "b"]


def test_rounding(spark):
    df = spark.createDataFrame([(23, 140), (21, 140), (27, 150), (26, 150), (1, 3)], "n long, t long")
    got = [r[0] for r in df.select(C.percent_of("n", "t")).collect()]
    assert got == [16.4, 15.0, 18.0, 17.3, 33.3]
    assert _one(spark, C.round_half_up(F.col("x")), 0.25, "x double") == 0.3


def test_time_labels_are_zone_free(spark):
    ms = 1577000000000  # 2019-12-22 07:33:20 UTC
    df = spark.createDataFrame([(ms,)], "ms long").select(C.ntz_from_millis("ms").alias("t"))
    r = df.select(
        C.date_label("t").alias("d"), C.minute_label("t").alias("m"), C.datetime_label("t").alias("dt")
    ).first()
    assert (r.d, r.m, r.dt) == ("2019-12-22", "07:33", "2019-12-22 07:33:20")
    back = df.select(C.millis_from_ntz("t").alias("ms")).first().ms
    assert back == ms
    assert df.select(C.date_label("t", "Asia/Shanghai").alias("d")).first().d == "2019-12-22"
    assert df.select(C.minute_label("t", "Asia/Shanghai").alias("m")).first().m == "15:33"
    # epoch ms must not depend on the session zone (daylight saving included)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        summer = spark.createDataFrame([(1719835200123,)], "ms long").select(C.ntz_from_millis("ms").alias("t"))
        assert summer.select(C.millis_from_ntz("t")).first()[0] == 1719835200123
        assert summer.select(C.datetime_label("t")).first()[0] == "2024-07-01 12:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_pairs_json(spark):
    df = spark.createDataFrame([([("2", 1200), ("9", 1100)],)], "p array<struct<k:string,v:bigint>>")
    assert df.select(C.pairs_json("p", "k", "v")).first()[0] == '[{"2":1200},{"9":1100}]'
    assert df.select(C.pairs_json_object("p", "k", "v")).first()[0] == '{"2":1200,"9":1100}'


def _clicks(spark, counts):
    rows = [("东", "p", city) for city, n in counts for _ in range(n)]
    return spark.createDataFrame(rows, "area string, product_name string, city_name string")


def test_city_share_samples(spark):
    # Counts behind the two sample outputs; the rest are spread over other cities.
    a = _clicks(spark, [("南京", 23), ("杭州", 21)] + [(f"c{i}", 12) for i in range(8)])
    r = city_share(a, ["area", "product_name"], "city_name").first()
    assert (r.product_count, r.city_click_ratio) == (140, "南京:16.4%,杭州:15.0%,其它：68.6%")
    b = _clicks(spark, [("无锡", 27), ("济南", 26)] + [(f"c{i}", 97 // 7 + (i < 97 % 7)) for i in range(7)])
    r = city_share(b, ["area", "product_name"], "city_name").first()
    assert r.city_click_ratio == "无锡:18.0%,济南:17.3%,其它：64.7%"


def test_city_share_one_city_and_null(spark):
    r = city_share(_clicks(spark, [("X", 5)]), ["area", "product_name"], "city_name").first()
    assert r.city_click_ratio == "X:100.0%,其它：0.0%"
    df = _clicks(spark, [("X", 3)]).unionByName(
        spark.createDataFrame([("东", "p", None)], "area string, product_name string, city_name string")
    )
    r = city_share(df, ["area", "product_name"], "city_name").first()
    assert (r.product_count, r.city_click_ratio) == (4, "X:75.0%,其它：25.0%")


def test_city_ratio_sql_function(spark):
    fn = register_city_ratio_function(spark)
    others = ", ".join(f"named_struct('city', 'c{i}', 'n', 12L)" for i in range(8))
    got = spark.sql(
        f"SELECT {fn}(array(named_struct('city', 'a', 'n', 23L), named_struct('city', 'b', 'n', 21L),"
        f" {others})) AS t"
    ).first().t
    assert got == "a:16.4%,b:15.0%,其它：68.6%"


def test_conditions_parse():
    text = (
        'condition.params.json={startDate:"2019-11-01", \\\n  endDate:"2019-12-28", \\\n'
        '  startAge: "20", endAge: "50", professionals: "", targetPageFlow:"1,2,3,4,5,6,7"}'
    )
    d = parse_lenient_json(text)
    c = Conditions.from_dict(d)
    assert (c.start_date, c.end_date, c.start_age_int, c.end_age_int) == ("2019-11-01", "2019-12-28", 20, 50)
    assert c.page_flow == [str(i) for i in range(1, 8)]
    assert Conditions.from_dict({"startAge": ""}).start_age is None  # empty = no filter (K16)


def test_flow_pairs():
    assert flow_pairs("1,2,3".split(",")) == [("1", "2"), ("2", "3")]


def _java_split(s: str, sep: str) -> list[str]:
    """Java String.split(sep) for a literal one-character separator."""
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_split_matches_java_on_generated_text(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    texts = st.lists(st.text(alphabet=" ,ab1", max_size=12), min_size=1, max_size=200)

    @settings(max_examples=15, deadline=None)
    @given(texts)
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "s string")
        got = df.select(C.split_like_java("s", ",").alias("c"), C.words("s").alias("w")).collect()
        for v, r in zip(values, got):
            assert r.c == _java_split(v, ","), v
            assert r.w == _java_split(v, " "), v

    check()
