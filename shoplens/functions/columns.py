"""Column-expression helpers: built-in Spark expressions, none a Python UDF.
Those with a lambda (``filter``, ``transform``) are evaluated in the JVM
outside generated code."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoplens.functions import constants as K

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- splitting (F1, F14) -------------------------------------------------------

def split_like_java(col, sep: str) -> Column:
    """``String.split(sep)`` semantics: trailing empty parts are dropped, an
    all-separator text gives no parts, the empty text gives one empty part.
    Spark's ``split`` keeps trailing empties, hence the trim first."""
    c = _c(col)
    pat = re.escape(sep)
    trimmed = F.regexp_replace(c, f"(?:{pat})+$", "")
    return (
        F.when(c == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, pat))
    )


def id_list(col, sep: str = K.ID_LIST_SEPARATOR) -> Column:
    """Comma-joined id text -> array of non-empty id strings (NULL stays NULL)."""
    return F.array_remove(F.split(_c(col), re.escape(sep)), "")


def words(col, sep: str = K.WORD_SEPARATOR) -> Column:
    """Tokenise a text line the way the word count does (Java split)."""
    return split_like_java(col, sep)


# --- numbers (F5, F6) ----------------------------------------------------------

def round_half_up(x, digits: int = 1) -> Column:
    """``Math.round(x * 10^d) / 10^d`` for the non-negative shares used here."""
    scale = float(10 ** digits)
    return F.floor(_c(x) * scale + 0.5) / scale


def percent_of(n, total) -> Column:
    """Share of ``n`` in ``total`` in percent, rounded half-up to 0.1."""
    return F.floor(_c(n).cast("double") * 1000.0 / _c(total) + 0.5) / 10.0


# --- time (F3, F4, F15) --------------------------------------------------------

def ntz_from_millis(ms) -> Column:
    """Epoch milliseconds -> wall-clock TIMESTAMP_NTZ in UTC (zone-free)."""
    return F.expr(f"timestampadd(MILLISECOND, {_sql(ms)}, {_EPOCH_NTZ})")


def millis_from_ntz(ts) -> Column:
    """Wall-clock UTC TIMESTAMP_NTZ -> epoch milliseconds (zone-free: built
    from date parts, since a timestamp difference would go through the
    session zone and shift across daylight-saving changes)."""
    t = _sql(ts)
    return F.expr(
        f"unix_date(CAST({t} AS DATE)) * 86400000L + hour({t}) * 3600000L + minute({t}) * 60000L"
        f" + CAST(floor(date_part('SECOND', {t}) * 1000) AS BIGINT)"
    )


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a ``datetime`` or ISO text, zone-free
    (a Python datetime literal would go through the session zone)."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")


def local_time(ts_ntz, tz: str = "UTC") -> Column:
    """Shift a UTC wall-clock NTZ value to the wall clock of ``tz``."""
    c = _c(ts_ntz)
    if tz.upper() == "UTC":
        return c
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), c)


def date_label(ts_ntz, tz: str = "UTC") -> Column:
    return F.date_format(local_time(ts_ntz, tz), K.DATE_FORMAT)


def datetime_label(ts_ntz, tz: str = "UTC") -> Column:
    return F.date_format(local_time(ts_ntz, tz), K.DATETIME_FORMAT)


def minute_label(ts_ntz, tz: str = "UTC") -> Column:
    return F.date_format(local_time(ts_ntz, tz), K.MINUTE_FORMAT)


def _sql(col) -> str:
    if isinstance(col, str):
        return f"`{col}`"
    raise TypeError("pass a column name")


# --- text and JSON (F7, F8, F9, F12) ------------------------------------------

def pairs_json(pairs, key_field: str, value_field: str) -> Column:
    """Array of structs -> JSON array of one-field objects, in array order:
    ``[{"a7":31},{"a4":30}]`` (what a list of pairs becomes in JSON)."""
    return F.to_json(
        F.transform(_c(pairs), lambda x: F.create_map(x[key_field], x[value_field]))
    )


def pairs_json_object(pairs, key_field: str, value_field: str) -> Column:
    """Same pairs as one JSON object ``{"a7":31,"a4":30}``."""
    return F.to_json(
        F.map_from_arrays(
            F.transform(_c(pairs), lambda x: x[key_field]),
            F.transform(_c(pairs), lambda x: x[value_field]),
        )
    )


def kv_key(prefix: str, *parts) -> Column:
    """Composite text key such as ``date_user_ad_<date>``."""
    return F.concat(F.lit(prefix), *[_c(p).cast("string") for p in parts])


def kv_field(*parts, sep: str = K.KEY_FIELD_SEPARATOR) -> Column:
    """Composite field such as ``<userid>:<adid>``."""
    return F.concat_ws(sep, *[_c(p).cast("string") for p in parts])
