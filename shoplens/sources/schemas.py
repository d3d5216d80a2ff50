"""Declared schemas of the job inputs and results (typed-row enforcement, P12)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

USER_VISIT_ACTION = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("action_time", T.StringType()),
        T.StructField("search_keyword", T.StringType()),
        T.StructField("click_category_id", T.LongType()),
        T.StructField("click_product_id", T.LongType()),
        T.StructField("order_category_ids", T.StringType()),
        T.StructField("order_product_ids", T.StringType()),
        T.StructField("pay_category_ids", T.StringType()),
        T.StructField("pay_product_ids", T.StringType()),
        T.StructField("city_id", T.LongType()),
    ]
)

USER_INFO = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("professional", T.StringType()),
        T.StructField("gender", T.StringType()),
    ]
)

PRODUCT_INFO = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("extend_info", T.StringType()),
    ]
)

CITY_INFO = T.StructType(
    [
        T.StructField("city_id", T.LongType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("area", T.StringType()),
    ]
)

# One ad click; ``timestamp`` is epoch milliseconds as on the wire.
ADS_LOG = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("area", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("userid", T.StringType()),
        T.StructField("adid", T.StringType()),
    ]
)

# Result tables.
CATEGORY_TOP10 = "task_id STRING, category_id STRING, click_count BIGINT, order_count BIGINT, pay_count BIGINT"
CATEGORY_SESSION_TOP10 = "task_id STRING, category_id STRING, session_id STRING, click_count BIGINT"
JUMP_PAGE_RATIO = "task_id STRING, jump STRING, ratio DOUBLE"
AREA_COUNT_INFO = (
    "task_id STRING, area STRING, product_name STRING, product_count BIGINT, city_click_ratio STRING"
)


def enforce(df: DataFrame, schema: T.StructType, keep_extra: bool = True) -> DataFrame:
    """Select the declared columns cast to the declared types (ANSI casts: bad
    values raise).  Extra columns (e.g. a tie-break id) are kept after them
    unless ``keep_extra`` is False."""
    names = [f.name for f in schema.fields]
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    if keep_extra:
        cols += [F.col(c) for c in df.columns if c not in names]
    return df.select(*cols)
