"""Registered queries (one per job / operator family) and their DuckDB oracles.

Each query is ``(spark, sf_dir) -> DataFrame`` over the whole given tables.
Each oracle is one DuckDB statement over the base tables; the adapter views
of ``sources/tables.py`` are inlined as CTEs in DuckDB's dialect.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens import params
from shoplens.functions import columns as C
from shoplens.functions import constants as K
from shoplens.operators.city_share import register_city_ratio_function
from shoplens.plans import ads as A
from shoplens.plans import area_product as Q4
from shoplens.plans import category as Q12
from shoplens.plans import page_jump as Q3
from shoplens.sources import schemas
from shoplens.sources import tables as T
from shoplens.streaming import ads_app

# Parameters the registered queries run with.
COND = params.TEST                      # dates 2024-01-03..28, ages 20..50
FLOW = [str(i) for i in range(1, 8)]    # target page flow 1..7
TEST_BAN_THRESHOLD = 3                  # the test data has <= 3 clicks per (day, user, ad)
WINDOW_MINUTES = 60


def _uva(spark, d, pushdown=False):
    if pushdown:
        return T.user_visit_action(spark, d, COND.start_date, COND.end_date)
    return T.user_visit_action(spark, d)


def _filtered(spark, d):
    return Q12.filter_actions(_uva(spark, d, pushdown=True), T.user_info(spark, d), COND)


def _q4_inputs(spark, d):
    return _uva(spark, d), T.city_info(spark, d), T.product_info(spark, d)


# --- larger fact for Q4: line items as product clicks --------------------------

def lineitem_clicks(spark: SparkSession, d: str) -> DataFrame:
    """Line items as clicks: product = part, city = the ordering customer's
    nation, area = its region (same shape as the action table's clicks)."""
    li = T.table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    orders = T.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    cust = T.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("l_partkey").alias("click_product_id"),
            F.col("c_nationkey").cast("bigint").alias("city_id"),
        )
    )


def _city_ratio_sql(spark: SparkSession, d: str) -> DataFrame:
    fn = register_city_ratio_function(spark)
    Q4.area_product_city_counts(*_q4_inputs(spark, d)).createOrReplaceTempView("area_product_city_count")
    return spark.sql(
        f"""
        SELECT area, product_name, sum(n) AS product_count,
               {fn}(collect_list(named_struct('city', city, 'n', n))) AS city_click_ratio
        FROM area_product_city_count
        GROUP BY area, product_name
        """
    )


def _area_product_top3_sql(spark: SparkSession, d: str) -> DataFrame:
    """Q4 as SQL over a chain of temp views (S2), for SQL users: clicks ->
    per-city counts -> per-product count and share text -> rank <= 3."""
    fn = register_city_ratio_function(spark)
    Q4.area_product_city_counts(*_q4_inputs(spark, d)).createOrReplaceTempView("area_product_city_count")
    spark.sql(
        f"""SELECT area, product_name, sum(n) AS product_count,
                   {fn}(collect_list(named_struct('city', city, 'n', n))) AS city_click_ratio
            FROM area_product_city_count GROUP BY area, product_name"""
    ).createOrReplaceTempView("area_product_count")
    return spark.sql(
        """SELECT area, product_name, product_count, city_click_ratio FROM (
             SELECT *, rank() OVER (PARTITION BY area ORDER BY product_count DESC) AS rk
             FROM area_product_count) WHERE rk <= 3"""
    )


def _ads(spark, d):
    return T.ads_log(spark, d)


def _kept(spark, d):
    return A.ads_after_ban(_ads(spark, d), TEST_BAN_THRESHOLD)


def _arriving(spark: SparkSession, d: str) -> DataFrame:
    """Clicks that arrive up to a minute and a half after their time, every
    997th with a clock ten years ahead."""
    ten_years = 3650 * 86_400_000
    return _ads(spark, d).select(
        "event_id",
        "adid",
        (F.col("timestamp") + F.when(F.col("event_id") % 997 == 0, ten_years).otherwise(0)).alias("timestamp"),
        (F.col("timestamp") + F.col("event_id") % 90 * 1000).alias("arrival"),
    )


def _top_ads_by_change(spark: SparkSession, d: str) -> DataFrame:
    """Q7 in two steps, as the stream does it: the top of the clicks before
    noon of every day, then the groups whose top the later clicks change."""
    dated = A.with_date(_ads(spark, d))
    key = ["date", "area", "adid"]
    early = dated.filter(F.hour("ts") < 12).groupBy(*key).agg(F.count(F.lit(1)).alias("cnt"))
    clicked = dated.filter(F.hour("ts") >= 12).select(*key).distinct()
    total = dated.join(clicked, key, "left_semi").groupBy(*key).agg(F.count(F.lit(1)).alias("cnt"))
    nothing = spark.createDataFrame([], ads_app.TOP_SCHEMA)
    before = ads_app.next_top(nothing, early, K.TOP_ADS)
    after = ads_app.next_top(before, total, K.TOP_ADS)
    current = before.join(after.select("date", "area"), ["date", "area"], "left_anti").unionByName(after)
    return current.select("date", "area", C.pairs_json("top", "adid", "cnt").alias("top3"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # Q1 / Q2
    "range_filter_actions": _filtered,
    "category_counts": lambda s, d: Q12.category_counts(_filtered(s, d)),
    "category_top10": lambda s, d: Q12.category_top10(_filtered(s, d)),
    "category_session_count": lambda s, d: Q12.category_session_counts(_filtered(s, d)),
    "category_session_top10": lambda s, d: Q12.category_session_top10(_filtered(s, d)),
    "category_session_kind_counts": lambda s, d: Q12.category_session_kind_counts(_filtered(s, d)),
    # Q3
    "page_visit_count": lambda s, d: Q3.page_visit_count(_uva(s, d), FLOW[:-1]),
    "session_page_pairs": lambda s, d: Q3.session_page_pairs(_uva(s, d))
    .groupBy("frm", "nxt")
    .agg(F.count(F.lit(1)).alias("c")),
    "page_jump_count": lambda s, d: Q3.page_jump_count(_uva(s, d), FLOW).select("jump", "c"),
    "page_jump_ratio": lambda s, d: Q3.page_jump_ratio(_uva(s, d), FLOW),
    "page_transition_counts": lambda s, d: Q3.page_transition_counts(_uva(s, d)),
    # Q4
    "area_product_count": lambda s, d: Q4.area_product_count(*_q4_inputs(s, d)),
    "city_share": lambda s, d: Q4.area_product_share(*_q4_inputs(s, d)),
    "city_ratio_sql": _city_ratio_sql,
    "area_product_rank": lambda s, d: Q4.area_product_rank(*_q4_inputs(s, d)),
    "area_product_top3": lambda s, d: Q4.area_product_top3(*_q4_inputs(s, d)),
    "area_product_top3_sql": _area_product_top3_sql,
    "area_product_top3_lineitem": lambda s, d: Q4.area_product_top3(
        lineitem_clicks(s, d), T.city_info(s, d), T.product_info(s, d)
    ),
    # Q5 .. Q9 (batch forms; batch = one day for the ban feedback)
    "ads_line_parse": lambda s, d: A.parse_ads_lines(T.ads_lines(_ads(s, d))),
    "daily_user_ad_count": lambda s, d: A.daily_user_ad_count(_ads(s, d)),
    "ban_list": lambda s, d: A.ban_list(_ads(s, d), TEST_BAN_THRESHOLD),
    "ads_after_ban": lambda s, d: _kept(s, d).select("event_id"),
    "ads_after_ban_hourly": lambda s, d: A.ads_after_ban_by_batch(
        _ads(s, d).withColumn("b", F.date_trunc("hour", "ts")), "b", TEST_BAN_THRESHOLD
    ).select("event_id"),
    "date_area_city_ad_count": lambda s, d: A.date_area_city_ad_count(_ads(s, d)),
    "filtered_date_area_city_ad_count": lambda s, d: A.date_area_city_ad_count(_kept(s, d)),
    "date_area_top_ads": lambda s, d: A.date_area_top_ads(A.date_area_city_ad_count(_ads(s, d))),
    "last_window_ad_clicks": lambda s, d: A.last_window_ad_clicks(_ads(s, d), WINDOW_MINUTES),
    "last_window_ad_clicks_json": lambda s, d: A.last_window_ad_clicks_json(_ads(s, d), WINDOW_MINUTES),
    "last_window_by_arrival": lambda s, d: A.last_window_ad_clicks(_arriving(s, d), WINDOW_MINUTES),
    "clicks_ahead_of_arrival": lambda s, d: A.clicks_ahead(_arriving(s, d)),
    "date_area_top_ads_by_change": _top_ads_by_change,
    "running_word_count": lambda s, d: A.running_word_count(T.ads_lines(_ads(s, d))),
    "ad_count_kv": lambda s, d: A.date_area_city_ad_kv(A.date_area_city_ad_count(_ads(s, d))),
    "top_ads_kv": lambda s, d: A.top_ads_kv(A.date_area_top_ads(A.date_area_city_ad_count(_ads(s, d)))),
    "date_user_ad_kv": lambda s, d: A.date_user_ad_kv(A.daily_user_ad_count(_ads(s, d))),
    "last_window_kv": lambda s, d: A.last_window_kv(A.last_window_ad_clicks_json(_ads(s, d), WINDOW_MINUTES)),
    "enforced_actions": lambda s, d: schemas.enforce(_uva(s, d), schemas.USER_VISIT_ACTION, keep_extra=False),
    "blacklist_kv": lambda s, d: A.blacklist_kv(A.ban_list(_ads(s, d), TEST_BAN_THRESHOLD)),
}


# --- DuckDB oracles --------------------------------------------------------------

_VIEWS = """
city_info AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, replace(r_name, ' ', '_') AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey),
user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name, CAST(10 + c_custkey % 50 AS INT) AS age,
         c_mktsegment AS professional, CASE WHEN c_custkey % 5 < 3 THEN 'M' ELSE 'F' END AS gender
  FROM customer),
product_info AS (SELECT p_partkey AS product_id, p_name AS product_name, p_type AS extend_info FROM part),
ev AS (SELECT event_id, ts, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
user_visit_action AS (
  SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, user_id,
    concat(user_id, '_', CAST(floor((day(ts) - 1) / 10.0) AS INT)) AS session_id,
    k % 10 + 1 AS page_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
    CASE WHEN event_type = 'view' THEN concat('kw_', k % 6) END AS search_keyword,
    CASE WHEN event_type = 'click' THEN k % 20 + 1 ELSE -1 END AS click_category_id,
    CASE WHEN event_type = 'click' THEN (event_id * 7) % 200 ELSE -1 END AS click_product_id,
    CASE WHEN event_type = 'signup' THEN concat(k % 20 + 1, ',', (k + 7) % 20 + 1) END AS order_category_ids,
    CASE WHEN event_type = 'signup' THEN concat(k % 20 + 1, ',', (k + 7) % 20 + 1) END AS order_product_ids,
    CASE WHEN event_type = 'purchase'
         THEN concat((k + 3) % 20 + 1, ',', (k + 9) % 20 + 1, ',', (k + 11) % 20 + 1) END AS pay_category_ids,
    CASE WHEN event_type = 'purchase' THEN concat((k + 3) % 20 + 1, ',', (k + 9) % 20 + 1) END AS pay_product_ids,
    user_id % 25 AS city_id
  FROM ev),
ads_log AS (
  SELECT event_id, epoch_us(ts) // 1000 AS timestamp, ts, area, city_name AS city,
         CAST(user_id AS VARCHAR) AS userid, CAST(k % 6 + 1 AS VARCHAR) AS adid
  FROM ev JOIN city_info ON city_id = user_id % 25),
f AS (
  SELECT ac.* FROM user_visit_action ac JOIN user_info ui ON ac.user_id = ui.user_id
  WHERE date >= '2024-01-03' AND date <= '2024-01-28' AND age >= 20 AND age <= 50),
u AS (
  SELECT CAST(click_category_id AS VARCHAR) c, 'c' t FROM f WHERE click_category_id <> -1
  UNION ALL SELECT unnest(string_split(order_category_ids, ',')), 'o' FROM f
    WHERE click_category_id = -1 AND order_category_ids IS NOT NULL
  UNION ALL SELECT unnest(string_split(pay_category_ids, ',')), 'p' FROM f
    WHERE click_category_id = -1 AND order_category_ids IS NULL AND pay_category_ids IS NOT NULL),
cc AS (
  SELECT c AS category_id, count(*) FILTER (WHERE t = 'c') AS click_count,
         count(*) FILTER (WHERE t = 'o') AS order_count, count(*) FILTER (WHERE t = 'p') AS pay_count
  FROM u GROUP BY c),
top AS (SELECT * FROM cc ORDER BY pay_count DESC, order_count DESC, click_count DESC, category_id LIMIT 10),
us AS (
  SELECT CAST(click_category_id AS VARCHAR) c, session_id, 'c' t FROM f WHERE click_category_id <> -1
  UNION ALL SELECT unnest(string_split(order_category_ids, ',')), session_id, 'o' FROM f
    WHERE click_category_id = -1 AND order_category_ids IS NOT NULL
  UNION ALL SELECT unnest(string_split(pay_category_ids, ',')), session_id, 'p' FROM f
    WHERE click_category_id = -1 AND order_category_ids IS NULL AND pay_category_ids IS NOT NULL),
csc AS (
  SELECT CAST(click_category_id AS VARCHAR) AS category_id, session_id, count(*) AS click_count FROM f
  WHERE CAST(click_category_id AS VARCHAR) IN (SELECT category_id FROM top) GROUP BY 1, 2),
pairs AS (
  SELECT page_id AS frm, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS nxt
  FROM user_visit_action),
jumps AS (
  SELECT concat(frm, '-', nxt) AS jump, frm, count(*) AS c FROM pairs
  WHERE frm BETWEEN 1 AND 6 AND nxt = frm + 1 GROUP BY 1, 2),
visits AS (SELECT page_id, count(*) AS n FROM user_visit_action WHERE page_id BETWEEN 1 AND 6 GROUP BY 1),
b AS (SELECT *, strftime(ts, '%Y-%m-%d') AS date FROM ads_log),
run AS (SELECT date, userid, adid, count(*) AS cnt FROM b GROUP BY ALL),
ban AS (SELECT userid, min(date) AS ban_date FROM run WHERE cnt >= 3 GROUP BY userid),
kept AS (SELECT b.* FROM b LEFT JOIN ban ON b.userid = ban.userid WHERE ban_date IS NULL OR b.date <= ban_date),
hb AS (SELECT *, date_trunc('hour', ts) AS hour_batch FROM b),
hrun AS (
  SELECT userid, hour_batch, sum(cnt) OVER (PARTITION BY date, userid, adid ORDER BY hour_batch
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
  FROM (SELECT date, userid, adid, hour_batch, count(*) AS cnt FROM hb GROUP BY ALL) x),
hban AS (SELECT userid, min(hour_batch) AS ban_batch FROM hrun WHERE total >= 3 GROUP BY userid),
dac AS (SELECT date, area, city, adid, count(*) AS cnt FROM b GROUP BY ALL),
top3 AS (
  SELECT date, area, concat('[', string_agg(concat('{"', adid, '":', cnt, '}'), ',' ORDER BY rn), ']') AS top3
  FROM (SELECT *, row_number() OVER (PARTITION BY date, area ORDER BY cnt DESC, adid) rn FROM (
          SELECT date, area, adid, CAST(sum(cnt) AS BIGINT) cnt FROM dac GROUP BY ALL) x) y
  WHERE rn <= 3 GROUP BY 1, 2),
win AS (
  SELECT adid, strftime(ts, '%H:%M') AS hhmm, date_trunc('minute', ts) AS m FROM ads_log
  WHERE date_trunc('minute', ts) > (SELECT date_trunc('minute', max(ts)) - INTERVAL 60 MINUTE FROM ads_log)),
arr AS (
  SELECT event_id, adid, timestamp + CASE WHEN event_id % 997 = 0 THEN 315360000000 ELSE 0 END AS timestamp,
         timestamp + event_id % 90 * 1000 AS arrival FROM ads_log),
"""


def _share_sql(clicks: str) -> str:
    """City-share aggregate over a CTE of (area, product_name, city_name)."""
    return f"""
  SELECT area, product_name, CAST(sum(n) AS BIGINT) AS product_count,
    concat(string_agg(concat(city_name, ':', CAST(ratio AS VARCHAR), '%'), ',' ORDER BY rn) FILTER (WHERE rn <= 2),
           ',其它：', CAST(floor((100 - sum(CASE WHEN rn <= 2 THEN ratio ELSE 0 END)) * 10 + 0.5) / 10 AS VARCHAR), '%')
      AS city_click_ratio
  FROM (SELECT *, floor(CAST(n AS DOUBLE) * 1000 / tot + 0.5) / 10 AS ratio FROM (
          SELECT *, row_number() OVER (PARTITION BY area, product_name ORDER BY n DESC, city_name) rn,
                 sum(n) OVER (PARTITION BY area, product_name) tot FROM (
            SELECT area, product_name, city_name, count(*) AS n FROM {clicks} GROUP BY 1, 2, 3) k) r) q
  GROUP BY 1, 2"""


_EXTRA = """
apc AS (
  SELECT c.area, p.product_name, c.city_name FROM user_visit_action a
  JOIN city_info c ON a.city_id = c.city_id JOIN product_info p ON a.click_product_id = p.product_id),
share AS (""" + _share_sql("apc") + """),
lic AS (
  SELECT c.area, p.product_name, c.city_name FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer cu ON o.o_custkey = cu.c_custkey
  JOIN city_info c ON CAST(cu.c_nationkey AS BIGINT) = c.city_id JOIN product_info p ON l.l_partkey = p.product_id),
lshare AS (""" + _share_sql("lic") + """)
"""

_TOP3_OF = """SELECT area, product_name, product_count, city_click_ratio FROM (
  SELECT *, rank() OVER (PARTITION BY area ORDER BY product_count DESC) rk FROM {src}) z WHERE rk <= 3"""

_FINAL = {
    "range_filter_actions": "SELECT * FROM f",
    "category_counts": "SELECT * FROM cc",
    "category_top10": "SELECT category_id, click_count, order_count, pay_count FROM top",
    "category_session_count": "SELECT * FROM csc",
    "category_session_top10": """SELECT category_id, session_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) rn FROM csc) r
  WHERE rn <= 10""",
    "page_visit_count": "SELECT * FROM visits",
    "session_page_pairs": "SELECT frm, nxt, count(*) AS c FROM pairs WHERE nxt IS NOT NULL GROUP BY 1, 2",
    "page_jump_count": "SELECT jump, c FROM jumps",
    "page_transition_counts": "SELECT frm, nxt, count(*) AS c FROM pairs GROUP BY 1, 2",
    "category_session_kind_counts": """SELECT c AS category_id, session_id,
  count(*) FILTER (WHERE t = 'c') AS click_count, count(*) FILTER (WHERE t = 'o') AS order_count,
  count(*) FILTER (WHERE t = 'p') AS pay_count FROM us GROUP BY 1, 2""",
    "page_jump_ratio": """SELECT jump, CAST(j.c AS DOUBLE) / coalesce(d.n, 1) AS ratio
  FROM jumps j LEFT JOIN visits d ON d.page_id = j.frm""",
    "area_product_count": "SELECT area, product_name, count(*) AS product_count FROM apc GROUP BY 1, 2",
    "city_share": "SELECT * FROM share",
    "city_ratio_sql": "SELECT * FROM share",
    "area_product_rank": """SELECT area, product_name, product_count,
  rank() OVER (PARTITION BY area ORDER BY product_count DESC) AS rk FROM (
  SELECT area, product_name, count(*) AS product_count FROM apc GROUP BY 1, 2) x""",
    "area_product_top3": _TOP3_OF.format(src="share"),
    "area_product_top3_sql": _TOP3_OF.format(src="share"),
    "area_product_top3_lineitem": _TOP3_OF.format(src="lshare"),
    "ads_line_parse": "SELECT event_id, timestamp, area, city, userid, adid FROM ads_log",
    "daily_user_ad_count": "SELECT * FROM run",
    "ban_list": "SELECT userid, ban_date FROM ban",
    "ads_after_ban": "SELECT event_id FROM kept",
    "ads_after_ban_hourly": """SELECT hb.event_id FROM hb LEFT JOIN hban ON hb.userid = hban.userid
  WHERE ban_batch IS NULL OR hb.hour_batch <= ban_batch""",
    "date_area_city_ad_count": "SELECT * FROM dac",
    "filtered_date_area_city_ad_count": "SELECT date, area, city, adid, count(*) AS cnt FROM kept GROUP BY ALL",
    "date_area_top_ads": "SELECT * FROM top3",
    "last_window_ad_clicks": "SELECT adid, hhmm, count(*) AS cnt FROM win GROUP BY 1, 2",
    "last_window_ad_clicks_json": """SELECT adid,
  concat('[', string_agg(concat('{"', hhmm, '":', cnt, '}'), ',' ORDER BY first_minute), ']') AS minutes
  FROM (SELECT adid, hhmm, count(*) AS cnt, min(m) AS first_minute FROM win GROUP BY 1, 2) x GROUP BY adid""",
    "last_window_by_arrival": """SELECT adid, strftime(make_timestamp(timestamp * 1000), '%H:%M') AS hhmm, count(*) AS cnt
  FROM arr WHERE timestamp <= arrival + 60000 AND date_trunc('minute', make_timestamp(arrival * 1000)) >
    (SELECT date_trunc('minute', make_timestamp(max(arrival) * 1000)) - INTERVAL 60 MINUTE FROM arr) GROUP BY 1, 2""",
    "clicks_ahead_of_arrival": "SELECT adid, count(*) AS cnt FROM arr WHERE timestamp > arrival + 60000 GROUP BY 1",
    "date_area_top_ads_by_change": "SELECT * FROM top3",
    "running_word_count": """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(
  concat_ws(' ', CAST(timestamp AS VARCHAR), area, city, userid, adid), ' ')) AS word FROM ads_log) w GROUP BY 1""",
    "ad_count_kv": """SELECT concat('date_area_city_ad_', date) AS key, concat_ws(':', area, city, adid) AS field,
  CAST(cnt AS VARCHAR) AS value FROM dac""",
    "top_ads_kv": "SELECT concat('top3_ads_per_day:', date) AS key, area AS field, top3 AS value FROM top3",
    "date_user_ad_kv": """SELECT concat('date_user_ad_', date) AS key, concat_ws(':', userid, adid) AS field,
  CAST(cnt AS VARCHAR) AS value FROM run""",
    "last_window_kv": """SELECT 'last_hour_ads_click' AS key, adid AS field,
  concat('[', string_agg(concat('{"', hhmm, '":', cnt, '}'), ',' ORDER BY first_minute), ']') AS value
  FROM (SELECT adid, hhmm, count(*) AS cnt, min(m) AS first_minute FROM win GROUP BY 1, 2) x GROUP BY adid""",
    "enforced_actions": """SELECT date, user_id, session_id, page_id, action_time, search_keyword, click_category_id, click_product_id,
  order_category_ids, order_product_ids, pay_category_ids, pay_product_ids, city_id FROM user_visit_action""",
    "blacklist_kv": "SELECT 'BlackList' AS key, userid AS field, userid AS value FROM ban",
}


def oracle_sql() -> dict[str, str]:
    head = "WITH " + _VIEWS + _EXTRA
    return {k: head + v for k, v in _FINAL.items()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
