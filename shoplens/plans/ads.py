"""Ad-click jobs Q5-Q9 in batch form.  The same functions run inside the
streaming drivers (``shoplens.streaming``) on each micro-batch or on the
state a streaming aggregation keeps, so batch and stream share one logic.

Input: a DataFrame of clicks with ``timestamp`` (epoch ms) and/or ``ts``
(UTC wall clock, TIMESTAMP_NTZ), area, city, userid, adid.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions import columns as C
from shoplens.functions import constants as K
from shoplens.operators.joins import null_safe_join
from shoplens.operators.topk import top_k_per_group


# --- P1 / P2: the wire format -------------------------------------------------

# Columns of a source by these names (a Kafka row has a ``timestamp``) give way
# to the parsed fields.
_PARSED = ("timestamp", "area", "city", "userid", "adid", "valid")


def parse_ads_lines(lines: DataFrame, value_col: str = "value", lenient: bool = False) -> DataFrame:
    """``timestamp area city userid adid`` text -> typed click rows.

    Strict (default, K19): a short line or a non-numeric timestamp raises,
    as in the reference.  ``lenient=True`` yields NULLs instead and adds a
    ``valid`` flag so callers can route rejects elsewhere."""
    parts = F.split(F.col(value_col).cast("string"), K.ADS_LINE_SEPARATOR)
    keep = [c for c in lines.columns if c != value_col and c not in _PARSED]
    if lenient:
        ts = F.expr(f"try_cast(try_element_at(split(CAST(`{value_col}` AS STRING), ' '), 1) AS BIGINT)")
        fields = [F.try_element_at(parts, F.lit(i)) for i in range(2, 6)]
        out = lines.select(
            *keep,
            ts.alias("timestamp"),
            *[f.alias(n) for f, n in zip(fields, ["area", "city", "userid", "adid"])],
        )
        return out.withColumn(
            "valid",
            F.col("timestamp").isNotNull() & F.col("adid").isNotNull(),
        )
    # explicit check, so a bad line fails the job whatever the ANSI setting
    ts = F.expr(f"try_cast(try_element_at(split(CAST(`{value_col}` AS STRING), ' '), 1) AS BIGINT)")
    bad = (F.size(parts) < 5) | ts.isNull()
    checked_ts = F.when(
        bad, F.raise_error(F.concat(F.lit("malformed ad-click line: "), F.col(value_col).cast("string")))
    ).otherwise(ts)
    return lines.select(
        *keep,
        checked_ts.cast("bigint").alias("timestamp"),
        F.element_at(parts, 2).alias("area"),
        F.element_at(parts, 3).alias("city"),
        F.element_at(parts, 4).alias("userid"),
        F.element_at(parts, 5).alias("adid"),
    )


def click_time(ads: DataFrame) -> Column:
    """UTC wall-clock time of a click (from ``ts`` if present, else ms)."""
    return F.col("ts") if "ts" in ads.columns else C.ntz_from_millis("timestamp")


def with_date(ads: DataFrame, tz: str = "UTC") -> DataFrame:
    if "date" in ads.columns:
        return ads
    return ads.withColumn("date", C.date_label(click_time(ads), tz))


# --- Q5: ban list -------------------------------------------------------------

def daily_user_ad_count(ads: DataFrame, tz: str = "UTC") -> DataFrame:
    """Clicks per (date, userid, adid)."""
    return (
        with_date(ads, tz)
        .groupBy("date", "userid", "adid")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def ban_list(ads: DataFrame, threshold: int = K.BAN_THRESHOLD, tz: str = "UTC") -> DataFrame:
    """P10 + S18, batch = one day: (userid, ban_date) where ban_date is the
    first day on which the user reached ``threshold`` clicks (``>=``, K11) on
    one ad.  Before a user is banned none of their clicks are dropped, so the
    raw daily counts decide the first ban exactly (valid from an empty ban
    list).  A ban is global and permanent (K12)."""
    return (
        daily_user_ad_count(ads, tz)
        .filter(F.col("cnt") >= threshold)
        .groupBy("userid")
        .agg(F.min("date").alias("ban_date"))
    )


def ads_after_ban(ads: DataFrame, threshold: int = K.BAN_THRESHOLD, tz: str = "UTC") -> DataFrame:
    """J3 + T7, batch = one day: clicks kept by the ban filter.  The banning
    day's own clicks still count; every later day of that user is dropped.

    The ban table has one row per banned user; Catalyst/AQE broadcast it when
    it is small and otherwise shuffle-join (with skew splitting of a hot
    user's partition).  The null-safe join lets the clicks and the ban
    table come from one scan of the input."""
    dated = with_date(ads, tz)
    bans = ban_list(dated, threshold, tz)
    return (
        null_safe_join(dated, bans, ["userid"], "left")
        .filter(F.col("ban_date").isNull() | (F.col("date") <= F.col("ban_date")))
        .drop("ban_date")
    )


def ban_list_by_batch(
    ads: DataFrame, batch_col: str, threshold: int = K.BAN_THRESHOLD, tz: str = "UTC"
) -> DataFrame:
    """Ban list for any micro-batch split (``batch_col`` orders the
    batches): (userid, ban_batch, ban_date).

    Running counts per (date, user, ad) accumulate over the batches in
    order; a user is banned in the first batch where one of them reaches the
    threshold, with the earliest such date of that batch.  Before the ban
    nothing of the user is dropped, so raw counts give the exact answer.
    Each (date, user, ad) group holds one row per batch, not per click."""
    per_batch = (
        with_date(ads, tz)
        .groupBy("date", "userid", "adid", batch_col)
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    running = Window.partitionBy("date", "userid", "adid").orderBy(batch_col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    first = (
        per_batch.withColumn("total", F.sum("cnt").over(running))
        .filter(F.col("total") >= threshold)
        .groupBy("userid")
        .agg(F.min(F.struct(F.col(batch_col).alias("b"), F.col("date").alias("d"))).alias("first"))
    )
    return first.select("userid", F.col("first.b").alias("ban_batch"), F.col("first.d").alias("ban_date"))


def ads_after_ban_by_batch(
    ads: DataFrame, batch_col: str, threshold: int = K.BAN_THRESHOLD, tz: str = "UTC"
) -> DataFrame:
    """Clicks the streaming ban filter keeps when the clicks arrive in the
    micro-batches given by ``batch_col``: a user's clicks up to and
    including the batch of their ban."""
    dated = with_date(ads, tz)
    bans = ban_list_by_batch(dated, batch_col, threshold, tz).drop("ban_date")
    return (
        null_safe_join(dated, bans, ["userid"], "left")
        .filter(F.col("ban_batch").isNull() | (F.col(batch_col) <= F.col("ban_batch")))
        .drop("ban_batch")
    )


# --- Q6 / Q7: running counts and top ads ---------------------------------------

def date_area_city_ad_count(ads: DataFrame, tz: str = "UTC") -> DataFrame:
    """Clicks per (date, area, city, adid); late clicks count under their
    own date (no watermark, T13)."""
    return (
        with_date(ads, tz)
        .groupBy("date", "area", "city", "adid")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def date_area_top_ads(counts: DataFrame, n: int = K.TOP_ADS, as_object: bool = False) -> DataFrame:
    """A10 + W4 + F9: from (date, area, city, adid, cnt) roll the city up and
    keep the n most clicked ads per (date, area) (adid ascending breaks
    ties) as a JSON array of one-field objects, ad id to clicks (K7)."""
    per_ad = counts.groupBy("date", "area", "adid").agg(F.sum("cnt").alias("cnt"))
    top = top_k_per_group(
        per_ad, ["date", "area"], [F.col("cnt").desc(), F.col("adid").asc()], n, rank_col="rn"
    )
    ranked = F.array_sort(F.collect_list(F.struct("rn", "adid", "cnt")))
    to_json = C.pairs_json_object if as_object else C.pairs_json
    return top.groupBy("date", "area").agg(to_json(ranked, "adid", "cnt").alias("top3"))


# --- Q8: trailing window of per-minute counts ---------------------------------

def _window_minutes(ads: DataFrame, window_minutes: int, end_time=None, ahead_seconds: int = K.AHEAD_SECONDS) -> DataFrame:
    """Clicks that came in the trailing window ending at the minute of
    ``end_time`` (default: the latest).  Whole minutes: minute > end minute -
    window (SURVEY 7.4).

    Clicks with an ``arrival`` (epoch ms) are placed by it, and those whose own
    clock is more than ``ahead_seconds`` ahead of it are left out
    (``clicks_ahead`` counts them), so no wrong clock moves the window; their
    labels are still their own minutes.  Clicks without one are placed by
    their own time.

    The latest time is computed first (a max over one column, one value back),
    so the window becomes a literal range on the click time that the Parquet
    reader can use to skip row groups outside it."""
    t, came = click_time(ads), click_time(ads)
    by_arrival = "arrival" in ads.columns
    if by_arrival:
        came = C.ntz_from_millis("arrival")
    if end_time is None:
        end_time = ads.select(F.max(came)).first()[0]
    if end_time is None:  # no clicks at all
        return ads.select("adid", F.lit(None).cast("timestamp_ntz").alias("minute"),
                          F.lit(None).cast("string").alias("hhmm")).limit(0)
    end = _dt.datetime.fromisoformat(str(end_time)).replace(second=0, microsecond=0, tzinfo=None)
    first_minute = end - _dt.timedelta(minutes=int(window_minutes) - 1)
    minute = F.date_trunc("minute", t)
    rows = ads
    if by_arrival:
        first_ms = int(first_minute.replace(tzinfo=_dt.timezone.utc).timestamp() * 1000)
        rows = ads.filter((F.col("arrival") >= first_ms) & ~_is_ahead(ads, ahead_seconds))
    elif "ts" in ads.columns:
        rows = ads.filter(t >= C.ntz_literal(first_minute))
    return rows.filter(F.date_trunc("minute", came) >= C.ntz_literal(first_minute)).select(
        "adid", minute.alias("minute"), C.minute_label(t).alias("hhmm")
    )


def _is_ahead(ads: DataFrame, ahead_seconds: int) -> Column:
    """Whether a click's clock is ahead of its arrival; unknown is not ahead."""
    ms = F.col("timestamp") if "timestamp" in ads.columns else F.unix_millis(F.col("ts").cast("timestamp"))
    return F.coalesce(ms > F.col("arrival") + int(ahead_seconds) * 1000, F.lit(False))


def clicks_ahead(ads: DataFrame, ahead_seconds: int = K.AHEAD_SECONDS) -> DataFrame:
    """(adid, cnt) of the clicks that the window by arrival leaves out."""
    return ads.filter(_is_ahead(ads, ahead_seconds)).groupBy("adid").agg(F.count(F.lit(1)).alias("cnt"))


def last_window_ad_clicks(
    ads: DataFrame, window_minutes: int = K.AD_WINDOW_MINUTES, end_time=None
) -> DataFrame:
    """T4 + F4: (adid, hhmm, cnt).  The ``HH:mm`` label has no date, so a
    window over a day long merges days under one label (K13)."""
    return (
        _window_minutes(ads, window_minutes, end_time)
        .groupBy("adid", "hhmm")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def last_window_ad_clicks_json(
    ads: DataFrame, window_minutes: int = K.AD_WINDOW_MINUTES, end_time=None
) -> DataFrame:
    """A8 + F9: one row per ad, ``minutes`` = JSON ``[{"12:01":5},...]`` in
    time order.  At most ``window_minutes`` entries per ad are collected."""
    per_minute = (
        _window_minutes(ads, window_minutes, end_time)
        .groupBy("adid", "hhmm")
        .agg(F.count(F.lit(1)).alias("cnt"), F.min("minute").alias("first_minute"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("first_minute", "hhmm", "cnt")))
    return per_minute.groupBy("adid").agg(C.pairs_json(ordered, "hhmm", "cnt").alias("minutes"))


# --- Q9: word count -------------------------------------------------------------

def running_word_count(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """F14 + T3: (word, n) over space-separated lines (Java split, K6)."""
    return (
        lines.select(F.explode(C.words(value_col)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- S14-S18: keyed (key, field, value) forms of the results --------------------

def date_user_ad_kv(daily: DataFrame) -> DataFrame:
    return daily.select(
        C.kv_key(K.KEY_DATE_USER_AD, "date").alias("key"),
        C.kv_field("userid", "adid").alias("field"),
        F.col("cnt").cast("string").alias("value"),
    )


def date_area_city_ad_kv(counts: DataFrame) -> DataFrame:
    return counts.select(
        C.kv_key(K.KEY_DATE_AREA_CITY_AD, "date").alias("key"),
        C.kv_field("area", "city", "adid").alias("field"),
        F.col("cnt").cast("string").alias("value"),
    )


def top_ads_kv(top: DataFrame) -> DataFrame:
    return top.select(
        C.kv_key(K.KEY_TOP3_ADS_PER_DAY, "date").alias("key"),
        F.col("area").alias("field"),
        F.col("top3").alias("value"),
    )


def last_window_kv(per_ad: DataFrame) -> DataFrame:
    return per_ad.select(
        F.lit(K.KEY_LAST_HOUR_ADS_CLICK).alias("key"),
        F.col("adid").alias("field"),
        F.col("minutes").alias("value"),
    )


def blacklist_kv(bans: DataFrame) -> DataFrame:
    return bans.select(
        F.lit(K.KEY_BLACKLIST).alias("key"),
        F.col("userid").alias("field"),
        F.col("userid").alias("value"),
    )
