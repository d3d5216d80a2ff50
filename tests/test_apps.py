"""The applications end to end on small inputs."""

import os

from shoplens import apps, params
from shoplens.plans import area_product as Q4
from shoplens.sources import tables as T
from shoplens.streaming import ads_app, sources

SF = "/root/testdata/sf0.001"


def test_offline_app_writes_all_results(spark):
    cond = params.TEST
    task = apps.run_offline(spark, SF, apps.table_writer("t_"), cond, task_id="aaa--1")
    assert task == "aaa--1"
    for name in ("category_top10", "category_session_top10", "jump_page_ratio", "area_count_info"):
        df = spark.table(f"t_{name}")
        assert df.columns[0] == "task_id" and df.count() > 0
        assert {r.task_id for r in df.select("task_id").distinct().collect()} == {"aaa--1"}
    want = Q4.area_product_top3(T.user_visit_action(spark, SF), T.city_info(spark, SF), T.product_info(spark, SF))
    got = spark.table("t_area_count_info").drop("task_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.table("t_category_top10").count() == 10


def test_realtime_app(spark, scratch):
    root = f"{scratch}/rt"
    os.makedirs(f"{root}/in")
    t0 = 1704067200000
    with open(f"{root}/in/a.txt", "w") as f:
        f.write("\n".join(f"{t0 + i * 1000} AREA C1 u{i % 2} {i % 3}" for i in range(12)) + "\n")
    lines = sources.text_file_stream(spark, f"{root}/in")
    qs = apps.start_realtime(lines, root, threshold=100, trigger={"availableNow": True})
    qs[0].awaitTermination()
    # the publishers may have started before the first file landed: run again
    for q in qs[1:]:
        q.awaitTermination()
    for q in apps.start_realtime_publishers(spark, root, trigger={"availableNow": True}):
        q.awaitTermination()
    counts, top = ads_app.read_area_counts(spark, f"{root}/snapshots")
    assert sum(int(r.value) for r in counts.collect()) == 12
    top = top.first()
    assert top.key == "top3_ads_per_day:2024-01-01" and top.value == '[{"0":4},{"1":4},{"2":4}]'


def test_outputs_match_declared_schemas(spark):
    """The result tables keep the declared column names and types (the
    contract of the relational tables they are appended to)."""
    from pyspark.sql.types import StructType

    from shoplens.sources import schemas

    apps.run_offline(spark, SF, apps.table_writer("s_"), params.TEST, task_id="aaa--2")
    for table, ddl in [
        ("s_category_top10", schemas.CATEGORY_TOP10),
        ("s_category_session_top10", schemas.CATEGORY_SESSION_TOP10),
        ("s_jump_page_ratio", schemas.JUMP_PAGE_RATIO),
        ("s_area_count_info", schemas.AREA_COUNT_INFO),
    ]:
        got = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields]
        want = [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(ddl).fields]
        assert got == want, table
    uva = T.user_visit_action(spark, SF)
    declared = [(f.name, f.dataType.simpleString()) for f in schemas.USER_VISIT_ACTION.fields]
    assert [(f.name, f.dataType.simpleString()) for f in uva.schema.fields][:13] == declared
