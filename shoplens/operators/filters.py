"""Predicates and classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions import constants as K
from shoplens.functions.columns import id_list
from shoplens.params import Conditions


def range_filter(df: DataFrame, col: str, low=None, high=None) -> DataFrame:
    """Inclusive ``low <= col <= high``; an absent (None / '') end adds no
    predicate.  Values are literals, never spliced into SQL text."""
    if low not in (None, ""):
        df = df.filter(F.col(col) >= F.lit(low))
    if high not in (None, ""):
        df = df.filter(F.col(col) <= F.lit(high))
    return df


def filter_actions(actions: DataFrame, users: DataFrame, cond: Conditions) -> DataFrame:
    """Actions in the date range done by users in the age range (J1 + P3).

    Inner join keeps the reference semantics (``select ac.*``): a duplicated
    user row would duplicate actions.  The age filter runs on the user side
    before the join; Catalyst chooses broadcast vs shuffle from sizes."""
    a = range_filter(actions, "date", cond.start_date, cond.end_date)
    u = range_filter(users.select("user_id", "age"), "age", cond.start_age_int, cond.end_age_int)
    return a.join(u.select("user_id"), "user_id", "inner").select(*actions.columns)


def action_kind() -> Column:
    """First match wins: click if the click id is set, else order if order
    ids are present, else pay if pay ids are present, else NULL (P6, K1)."""
    return (
        F.when(F.col("click_category_id") != K.NOT_A_CLICK, F.lit("click"))
        .when(F.col("order_category_ids").isNotNull(), F.lit("order"))
        .when(F.col("pay_category_ids").isNotNull(), F.lit("pay"))
    )


def action_categories() -> Column:
    """Category ids touched by an action, following the same precedence."""
    return (
        F.when(
            F.col("click_category_id") != K.NOT_A_CLICK,
            F.array(F.col("click_category_id").cast("string")),
        )
        .when(F.col("order_category_ids").isNotNull(), id_list("order_category_ids"))
        .when(F.col("pay_category_ids").isNotNull(), id_list("pay_category_ids"))
    )


def is_click() -> Column:
    return F.col("click_category_id") != K.NOT_A_CLICK
