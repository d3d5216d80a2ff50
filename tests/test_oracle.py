"""Every query of the reference's own operators against its DuckDB oracle (the driver's gate), at
sf0.001 for speed; ``python tests/oracle_compare.py`` runs sf0.01."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck
from shoplens import registry

SF = "/root/testdata/sf0.001"
KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(registry.queries())
    assert set(KEYS) <= set(E.queries()) and set(KEYS) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, SF, key, E.queries()[key], E.oracle_sql()[key])
    assert r["ok"], r


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["area", "product_name", "product_count", "city_click_ratio"]
    assert df.count() > 0


def test_results_do_not_depend_on_partitioning(spark):
    q = E.queries()
    keys = ["category_session_top10", "page_jump_ratio", "area_product_top3", "date_area_top_ads"]
    first = {k: sorted(map(tuple, q[k](spark, SF).collect())) for k in keys}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        for k in keys:
            assert sorted(map(tuple, q[k](spark, SF).collect())) == first[k], k
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_results_do_not_depend_on_session_settings(spark, con):
    """The driver's session may use another time zone or no AQE."""
    keys = ["range_filter_actions", "category_top10", "last_window_ad_clicks", "ads_line_parse",
            "daily_user_ad_count", "session_page_pairs"]
    old_tz = spark.conf.get("spark.sql.session.timeZone")
    old_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for k in keys:
            r = compare(spark, con, SF, k, E.queries()[k], E.oracle_sql()[k])
            assert r["ok"], r
    finally:
        spark.conf.set("spark.sql.session.timeZone", old_tz)
        spark.conf.set("spark.sql.adaptive.enabled", old_aqe)


def test_results_under_cluster_settings(spark, con):
    """session.CLUSTER_CONF (8000 initial shuffle partitions coalesced by AQE,
    skew thresholds, RocksDB) changes plans, not results."""
    from shoplens.session import CLUSTER_CONF

    old = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        for k, v in CLUSTER_CONF.items():
            spark.conf.set(k, v)
        for k in ["category_session_top10", "area_product_top3", "page_jump_ratio"]:
            r = compare(spark, con, SF, k, E.queries()[k], E.oracle_sql()[k])
            assert r["ok"], r
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
