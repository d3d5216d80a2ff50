"""Q4: top-3 products per area (ties kept) with the leading cities' share of
clicks.  Groups by product *name*, so equal names merge (K10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions import constants as K
from shoplens.operators.city_share import share_of_counts
from shoplens.operators.joins import join_dimension, null_safe_join
from shoplens.operators.topk import top_k_per_group

_GROUP = ["area", "product_name"]


def area_product_city_counts(actions: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """(area, product_name, city, n): the star join (J2) after counting.

    Clicks are counted per (product id, city id) first, so the joins see one
    row per pair whatever the number of clicks, and a hot product is reduced
    on the map side; equal names then add up (K10)."""
    pairs = (
        actions.filter(F.col("click_product_id") != K.NOT_A_CLICK)
        .groupBy(F.col("click_product_id").alias("product_id"), "city_id")
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    with_city = join_dimension(pairs, cities.select("city_id", "city_name", "area"), "city_id")
    named = join_dimension(with_city, products.select("product_id", "product_name"), "product_id")
    return named.groupBy("area", "product_name", F.col("city_name").alias("city")).agg(F.sum("clicks").alias("n"))


def area_product_count(actions: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """Clicks per (area, product_name)."""
    return _totals(area_product_city_counts(actions, cities, products))


def _totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("area", "product_name").agg(F.sum("n").alias("product_count"))


def area_product_share(actions: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """A6 + A7: (area, product_name, product_count, city_click_ratio)."""
    counts = area_product_city_counts(actions, cities, products)
    return share_of_counts(counts, _totals(counts), _GROUP)


def area_product_top3(
    actions: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    n: int = K.TOP_PRODUCTS,
    task_id: str | None = None,
) -> DataFrame:
    """Products ranked ``<= n`` by clicks inside their area (``rank``: ties
    kept, so an area may return more than n rows).  Products are ranked on
    their totals; the share text is made for the ranked ones only."""
    counts = area_product_city_counts(actions, cities, products)
    ranked = top_k_per_group(_totals(counts), ["area"], [F.col("product_count").desc()], n, with_ties=True)
    of_ranked = null_safe_join(counts, ranked.select(*_GROUP), _GROUP, "left_semi")
    top = share_of_counts(of_ranked, ranked, _GROUP)
    cols = ["area", "product_name", "product_count", "city_click_ratio"]
    if task_id is not None:
        return top.select(F.lit(task_id).alias("task_id"), *cols)
    return top.select(*cols)


def area_product_rank(actions: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """W1 on its own: every (area, product) with its click rank in the area.

    The window runs over an area's distinct counts, not its products: the rank
    of a count is one more than the products with larger counts."""
    counts = area_product_count(actions, cities, products)
    larger = Window.partitionBy("area").orderBy(F.col("product_count").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        counts.groupBy("area", "product_count")
        .agg(F.count(F.lit(1)).alias("products"))
        .select("area", "product_count", (F.coalesce(F.sum("products").over(larger), F.lit(0)) + 1).alias("rk"))
    )
    ranked = null_safe_join(counts, ranks, ["area", "product_count"])
    return ranked.select("area", "product_name", "product_count", "rk")
