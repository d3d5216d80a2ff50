"""Scans of the given tables and the adapter views that give them the
reference's data model (actions with sessions/pages/categories, users,
products, cities, ad clicks).

All views are lazy DataFrames over ``spark.read.parquet``, so Catalyst prunes
columns and pushes filters into the scans.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions import columns as C
from shoplens.functions import constants as K
from shoplens.operators.joins import join_dimension

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Catalog-style scan of one base table.

    The files are listed anew by every call, so files added since are read.
    A ``catalog:<prefix>`` location reads staged catalog tables instead."""
    if sf_dir.startswith(CATALOG):  # tables staged in the catalog (stage_tables)
        return spark.table(f"{sf_dir[len(CATALOG):]}{name}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ``catalog:<prefix>`` as the table location reads catalog tables
# ``<prefix><name>`` instead of Parquet files.
CATALOG = "catalog:"

# Tables joined on the user id by the jobs (Q1 joins actions with users);
# staged bucketed on it so that join needs no shuffle.
USER_KEYED = {"events": "user_id", "customer": "c_custkey"}


def stage_tables(spark: SparkSession, sf_dir: str, prefix: str, buckets: int, names=None) -> str:
    """Copy the base tables into catalog tables ``<prefix><name>``; the
    user-keyed ones bucketed and sorted on the user id with the same bucket
    count, so their join is co-located.  Returns the ``catalog:`` location
    to pass as ``sf_dir``.  Worth it for inputs read by many runs."""
    from shoplens.sinks.catalog import replace_table

    for name in names or TABLES:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        key = USER_KEYED.get(name)
        if key:
            replace_table(df, f"{prefix}{name}", bucket_by=(buckets, [key]), sort_by=[key])
        else:
            replace_table(df, f"{prefix}{name}")
    return f"{CATALOG}{prefix}"


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register every base table and adapter view as a temp view."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    city_info(spark, sf_dir).createOrReplaceTempView("city_info")
    user_info(spark, sf_dir).createOrReplaceTempView("user_info")
    product_info(spark, sf_dir).createOrReplaceTempView("product_info")
    user_visit_action(spark, sf_dir).createOrReplaceTempView("user_visit_action")
    ads_log(spark, sf_dir).createOrReplaceTempView("ads_log")


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """city = nation, area = region; spaces in area names become '_' so an
    ad-click wire line keeps exactly five space-separated fields."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "CAST(n_nationkey AS BIGINT) AS city_id", "n_name AS city_name", "replace(r_name, ' ', '_') AS area"
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id",
        "c_name AS username",
        "c_name AS name",
        "CAST(10 + c_custkey % 50 AS INT) AS age",
        "c_mktsegment AS professional",
        "CASE WHEN c_custkey % 5 < 3 THEN 'M' ELSE 'F' END AS gender",
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id", "p_name AS product_name", "p_type AS extend_info"
    )


def _events(spark: SparkSession, sf_dir: str, start_date=None, end_date=None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    # Date-range pushdown: the string filter on `date` cannot reach the parquet
    # reader, an equivalent half-open range on the raw `ts` column can.
    if start_date:
        ev = ev.filter(F.col("ts") >= C.ntz_literal(_dt.datetime.fromisoformat(start_date)))
    if end_date:
        end = _dt.datetime.fromisoformat(end_date) + _dt.timedelta(days=1)
        ev = ev.filter(F.col("ts") < C.ntz_literal(end))
    return ev.selectExpr(
        "event_id", "ts", "user_id", "event_type", "CAST(get_json_object(props, '$.k') AS BIGINT) AS k"
    )


# The action view as SQL expressions over (event_id, ts, user_id, event_type,
# k): a single projection, typed as the reference's schema.
_UVA_EXPRS = [
    f"date_format(ts, '{K.DATE_FORMAT}') AS date",
    "user_id",
    "concat(user_id, '_', CAST(floor((day(ts) - 1) / 10.0) AS INT)) AS session_id",
    "k % 10 + 1 AS page_id",
    f"date_format(ts, '{K.DATETIME_FORMAT}') AS action_time",
    "CASE WHEN event_type = 'view' THEN concat('kw_', k % 6) END AS search_keyword",
    "CASE WHEN event_type = 'click' THEN k % 20 + 1 ELSE -1 END AS click_category_id",
    "CASE WHEN event_type = 'click' THEN (event_id * 7) % 200 ELSE -1 END AS click_product_id",
    "CASE WHEN event_type = 'signup' THEN concat(k % 20 + 1, ',', (k + 7) % 20 + 1) END AS order_category_ids",
    "CASE WHEN event_type = 'signup' THEN concat(k % 20 + 1, ',', (k + 7) % 20 + 1) END AS order_product_ids",
    "CASE WHEN event_type = 'purchase' THEN concat((k + 3) % 20 + 1, ',', (k + 9) % 20 + 1, ',', (k + 11) % 20 + 1)"
    " END AS pay_category_ids",
    "CASE WHEN event_type = 'purchase' THEN concat((k + 3) % 20 + 1, ',', (k + 9) % 20 + 1) END AS pay_product_ids",
    "user_id % 25 AS city_id",
    "event_id",
]


def user_visit_action(
    spark: SparkSession, sf_dir: str, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """One row per action; 13 reference columns plus ``event_id`` (the
    tie-break for equal action times).  ``start_date``/``end_date`` only add
    a scan-level pre-filter; callers still apply the exact date filter."""
    return _events(spark, sf_dir, start_date, end_date).selectExpr(*_UVA_EXPRS)


def ads_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad clicks: ``timestamp`` (epoch ms), ``ts`` (UTC wall clock), area,
    city, userid, adid, plus ``event_id`` as a stable row id."""
    ev = _events(spark, sf_dir)
    cities = city_info(spark, sf_dir)
    # 25 city keys: a shuffle join would put the clicks on 25 reducers, so the
    # (row-count checked) broadcast is what keeps this join flat.
    return join_dimension(ev, cities, F.expr("user_id % 25") == F.col("city_id")).select(
        "event_id",
        C.millis_from_ntz("ts").alias("timestamp"),
        "ts",
        "area",
        F.col("city_name").alias("city"),
        F.expr("CAST(user_id AS STRING)").alias("userid"),
        F.expr("CAST(k % 6 + 1 AS STRING)").alias("adid"),
    )


def ads_lines(ads: DataFrame, keep=("event_id",)) -> DataFrame:
    """Wire form of ad clicks: one ``value`` line per click (plus ``keep``
    columns when present)."""
    return ads.select(
        F.concat_ws(" ", F.col("timestamp").cast("string"), "area", "city", "userid", "adid").alias(
            "value"
        ),
        *[c for c in keep if c in ads.columns],
    )
