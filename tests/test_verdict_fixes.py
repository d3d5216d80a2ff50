"""Faults of the stores, sources and the app's control that once lost data."""

import json

import pytest

from shoplens.params import parse_lenient_json
from shoplens.plans import ads as A
from shoplens.sinks import catalog, fs
from shoplens.sources import tables
from shoplens.streaming import control


def test_kafka_row_columns_give_way_to_parsed_fields(spark):
    rows = spark.sql(
        "SELECT CAST('1577000000000 north c1 3 2' AS BINARY) AS value, 'ads' AS topic, 0 AS partition, "
        "CAST(7 AS BIGINT) AS offset, current_timestamp() AS timestamp"
    )
    parsed = A.with_date(A.parse_ads_lines(rows))
    row = parsed.select("timestamp", "userid", "offset", "date").first()
    assert (row.timestamp, row.userid, row.offset) == (1577000000000, "3", 7)


def test_appended_files_are_read(spark, scratch):
    path = f"{scratch}/appended/region.parquet"
    spark.range(3).write.parquet(path)
    assert tables.table(spark, f"{scratch}/appended", "region").count() == 3
    spark.range(4).write.mode("append").parquet(path)
    assert tables.table(spark, f"{scratch}/appended", "region").count() == 7


def test_rename_reports_a_refusal(spark, scratch):
    with pytest.raises(Exception):
        fs.rename(spark, f"{scratch}/not-there", f"{scratch}/x/y/z")


def test_quoted_values_are_left_alone():
    assert parse_lenient_json('{keywords:"a, b:c", startAge: "1"}') == {"keywords": "a, b:c", "startAge": "1"}
    assert json.loads('{"k": "a, b:c"}') == parse_lenient_json('{"k": "a, b:c"}')


def test_replacing_a_table_may_read_it(spark):
    catalog.replace_table(spark.range(3).toDF("n"), "replaced_t")
    catalog.replace_table(spark.table("replaced_t").selectExpr("n + 10 AS n"), "replaced_t")
    assert sorted(r.n for r in spark.table("replaced_t").collect()) == [10, 11, 12]


def test_one_failed_query_stops_the_app(spark, scratch):
    def broken(batch, _):
        raise ValueError("broken sink")

    source = spark.readStream.format("rate").load()
    bad = source.writeStream.foreachBatch(broken).option("checkpointLocation", f"{scratch}/ck-bad").start()
    good = source.writeStream.format("noop").option("checkpointLocation", f"{scratch}/ck-good").start()
    with pytest.raises(Exception):
        control.run_all(spark, [good, bad], poll_seconds=0.2)
    assert not good.isActive
