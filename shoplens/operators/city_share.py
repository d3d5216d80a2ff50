"""City click-share aggregate.

For each group: the click count and a text naming the two leading cities with
their share of the group's clicks, rounded half-up to 0.1%, plus the rest:
``甲市:50.0%,乙市:30.0%,其它：20.0%``.  The rest is 100 minus the two
*rounded* shares, rounded again; it is always present (``其它：0.0%``).

Plan shape (no group is ever materialised whole):
  1. ``groupBy(group, city).count()``             partial + final hash agg
  2. totals per group from (1)                    same exchange is reused
  3. top-2 cities per group from (1)              row_number <= 2 ->
                                                  partial WindowGroupLimit;
                                                  (2) and (3) share (1)'s shuffle
  4. join (2) x (3) on the group keys             null-safe, so (1) stays
                                                  shared; it shuffles one row
                                                  per group, not per click
A NULL city counts toward the total but is never named.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions import constants as K
from shoplens.operators.joins import null_safe_join
from shoplens.operators.topk import top_k_per_group


def share_sql(lead: str, total: str) -> str:
    """SQL of the text from the leading ``(city, n)`` entries, in order, and the
    group total: the one place where the rule stands (U1, U2)."""
    percent = f"floor(x.n * 1000.0D / {total} + 0.5D) / 10"
    text = lambda r: f"CAST({r} AS STRING), '{K.SHARE_PERCENT_SIGN}'"
    rest = "floor(aggregate(s, 100.0D, (left, x) -> left - x.r) * 10 + 0.5D) / 10"
    return f"""element_at(transform(
        array(transform({lead}, x -> named_struct('city', x.city, 'r', {percent}))),
        s -> concat_ws('{K.SHARE_ITEM_SEPARATOR}',
          transform(s, x -> concat(x.city, '{K.SHARE_CITY_SEPARATOR}', {text("x.r")})),
          concat('{K.OTHER_CITIES_LABEL}', {text(rest)}))), 1)"""


def city_share(
    df: DataFrame,
    group_cols: Sequence[str],
    city_col: str,
    count_col: str = "product_count",
    text_col: str = "city_click_ratio",
    top: int = K.SHARE_TOP_CITIES,
) -> DataFrame:
    """``group_cols + [count_col, text_col]``, one row per group."""
    g = list(group_cols)
    counts = df.groupBy(*g, F.col(city_col).alias("city")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*g).agg(F.sum("n").alias(count_col))
    return share_of_counts(counts, totals, g, count_col, text_col, top)


def share_of_counts(
    counts: DataFrame,
    totals: DataFrame,
    group_cols: Sequence[str],
    count_col: str = "product_count",
    text_col: str = "city_click_ratio",
    top: int = K.SHARE_TOP_CITIES,
) -> DataFrame:
    """``totals`` (``group_cols + [count_col]``) with the share text from
    ``counts`` (``group_cols + [city, n]``, one row per group and city)."""
    g = list(group_cols)
    # NULL city sorts last and is dropped from the names below; filtering it
    # out here instead would be pushed under the shared aggregate and stop
    # Spark from reusing its shuffle for both branches.
    leaders = top_k_per_group(
        counts,
        g,
        [F.col("city").isNull().asc(), F.col("n").desc(), F.col("city").asc()],
        top,
        rank_col="rn",
    )
    named = leaders.groupBy(*g).agg(
        F.filter(
            F.array_sort(F.collect_list(F.struct("rn", "city", "n"))), lambda x: x["city"].isNotNull()
        ).alias("lead")
    )
    nobody = F.array().cast("array<struct<rn:int,city:string,n:bigint>>")
    joined = null_safe_join(totals, named, g, "left").withColumn("lead", F.coalesce("lead", nobody))
    return joined.select(*g, F.col(count_col), F.expr(share_sql("lead", f"`{count_col}`")).alias(text_col))


# SQL form for SQL callers (U1 re-aimed): a scalar function over the per-city
# counts of one group, which has at most one entry per city.
CITY_RATIO_SQL_FUNCTION = "city_ratio_text"


def register_city_ratio_function(spark: SparkSession, name: str = CITY_RATIO_SQL_FUNCTION) -> str:
    """Register ``name(counts ARRAY<STRUCT<city STRING, n BIGINT>>) -> STRING``.

    Use it on per-city counts, e.g.::

        SELECT area, product_name, sum(n) AS ct,
               city_ratio_text(collect_list(named_struct('city', city_name, 'n', n)))
        FROM (SELECT area, product_name, city_name, count(*) n FROM t GROUP BY 1, 2, 3)
        GROUP BY 1, 2
    """
    lead = f"""slice(array_sort(filter(counts, x -> x.city IS NOT NULL),
                           (a, b) -> CASE WHEN a.n > b.n THEN -1 WHEN a.n < b.n THEN 1
                                          WHEN a.city < b.city THEN -1 WHEN a.city > b.city THEN 1
                                          ELSE 0 END), 1, {K.SHARE_TOP_CITIES})"""
    total = "aggregate(counts, 0L, (sum, c) -> sum + c.n)"
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(counts ARRAY<STRUCT<city: STRING, n: BIGINT>>)
        RETURNS STRING
        RETURN {share_sql(lead, total)}
        """
    )
    return name
