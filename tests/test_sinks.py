"""Sinks: catalog replace round trip, writer options (published tables:
``test_commits.py``).

JDBC and Kafka writes need a database / broker process; none is started
here, so only their option building and record shaping are tested."""

import pytest

from shoplens.sinks import catalog, jdbc, topic
from shoplens.sources import schemas


def test_catalog_replace_round_trip(spark):
    rows = [(1, "北京", "华北"), (2, "上海", "华东")]
    df = catalog.from_rows(spark, rows, schemas.CITY_INFO)
    catalog.replace_table(df, "city_info_t")
    catalog.replace_table(df.limit(1), "city_info_t")  # replaced, not appended
    got = catalog.read_table(spark, "city_info_t", schemas.CITY_INFO).collect()
    assert [tuple(r) for r in got] == [rows[0]]
    catalog.replace_table(df, "city_info_b", bucket_by=(4, ["city_id"]), sort_by=["city_id"])
    assert spark.table("city_info_b").count() == 2


def test_a_failure_between_write_and_switch_keeps_the_old_table(spark, monkeypatch):
    catalog.replace_table(spark.range(3).toDF("n"), "switch_t")
    reader = spark.table("switch_t")
    with monkeypatch.context() as m:
        m.setattr(catalog, "_point", lambda *_: (_ for _ in ()).throw(OSError("catalog away")))
        with pytest.raises(OSError):
            catalog.replace_table(spark.range(9).toDF("n"), "switch_t")
    assert spark.table("switch_t").count() == 3
    catalog.replace_table(spark.range(5).toDF("n"), "switch_t")
    assert spark.table("switch_t").count() == 5
    assert reader.count() == 3  # planned on the version before, which is kept
    for n in (6, 7, 8):
        catalog.replace_table(spark.range(n).toDF("n"), "switch_t", keep=2)
    assert spark.table("switch_t").count() == 8 and len(catalog.versions(spark, "switch_t")) == 2


def test_a_plain_table_becomes_the_first_version(spark):
    spark.range(4).toDF("n").write.saveAsTable("plain_t")
    catalog.replace_table(spark.table("plain_t").selectExpr("n + 1 AS n"), "plain_t")
    assert sorted(r.n for r in spark.table("plain_t").collect()) == [1, 2, 3, 4]
    assert len(catalog.versions(spark, "plain_t")) == 2


class Recorder:
    """A connection whose statements run on temp views instead of a database:
    what the log, the staging table and the target would hold."""

    log, target, fail = set(), [], None

    def __init__(self, spark, options):
        self.spark, self.table = spark, options["dbtable"]

    def count(self, sql, parameters):
        assert sql == f"SELECT COUNT(*) FROM {self.table}_published WHERE run_id = ?"
        return int(parameters[0] in Recorder.log)

    def run(self, statements):
        (log, (run,)), (insert, (also,)), (clean, _) = statements
        assert log == f"INSERT INTO {self.table}_published (run_id) VALUES (?)" and run == also
        assert clean == f"DELETE FROM {self.table}_staging WHERE run_id = ?"
        if Recorder.fail:
            raise OSError(Recorder.fail)
        into, select = insert.split(" SELECT ", 1)
        assert into == f"INSERT INTO {self.table} (page, n)"
        rows = self.spark.sql("SELECT " + select.replace("?", f"'{run}'")).collect()
        Recorder.log.add(run)
        Recorder.target += [tuple(r) for r in rows]

    def close(self):
        pass


def test_a_retried_partition_or_job_adds_nothing(spark, monkeypatch):
    df = spark.range(100).selectExpr("concat('p', id % 7) AS page", "id DIV 10 AS n")  # with repeated rows
    want = sorted(map(tuple, df.collect()))
    staged = []

    def stage(rows, opts):
        part = rows.filter("part_no = 1")
        assert part.count()
        out = rows.unionByName(part)  # a task that failed after its commit, tried again
        staged.append(out if not staged else staged[-1].unionByName(out))
        staged[-1].createOrReplaceTempView("pages_staging")

    monkeypatch.setattr(jdbc, "stage_rows", stage)
    options = {"url": "jdbc:none", "table": "pages", "connect": Recorder, "max_connections": 3}
    Recorder.fail = "lost"
    with pytest.raises(OSError):
        jdbc.append(df, run="r1", **options)
    assert Recorder.target == []
    Recorder.fail = None
    jdbc.append(df, run="r1", **options)  # staged a second time, under the same numbers
    assert sorted(Recorder.target) == want
    jdbc.append(df, run="r1", **options)
    assert sorted(Recorder.target) == want and len(staged) == 2
    other = jdbc.append(df, **options)
    assert other != "r1" and sorted(Recorder.target) == sorted(want * 2)


def test_rows_keep_their_numbers(spark):
    rows = jdbc.numbered(spark.range(1000).selectExpr("rand() AS x"), "r", 4)
    first = sorted(map(tuple, rows.collect()))
    assert first == sorted(map(tuple, rows.collect()))
    assert len({(r[1], r[2]) for r in first}) == 1000 and {r[1] for r in first} == {0, 1, 2, 3}
    assert max(r[2] for r in first) < 1000


def test_jdbc_setup_statements():
    log, staging = jdbc.setup_statements("t", "page VARCHAR(9), n BIGINT")
    assert log == "CREATE TABLE t_published (run_id VARCHAR(64) PRIMARY KEY)"
    assert staging == "CREATE TABLE t_staging (run_id VARCHAR(64), part_no INT, row_no BIGINT, page VARCHAR(9), n BIGINT)"


def test_jdbc_options():
    o = jdbc.jdbc_options("jdbc:mysql://db/x", "category_top10", user="u", password="p", batchsize=500)
    assert o == {
        "url": "jdbc:mysql://db/x", "dbtable": "category_top10", "batchsize": "500",
        "isolationLevel": "READ_COMMITTED", "user": "u", "password": "p",
    }


def test_topic_records(spark):
    df = spark.createDataFrame([("1577000000000 华北 北京 3 2", 7)], "line string, k long")
    r = topic.as_records(df, "line", "k").first()
    assert (r.key, r.value) == ("7", "1577000000000 华北 北京 3 2")
    assert topic.topic_options("h:9092", "ads_log") == {"kafka.bootstrap.servers": "h:9092", "topic": "ads_log"}


def test_staged_bucketed_tables_join_without_shuffle(spark):
    import re

    from shoplens import registry as R
    from shoplens.operators.filters import filter_actions
    from shoplens.sources import tables as T

    sf = "/root/testdata/sf0.001"
    loc = T.stage_tables(spark, sf, "bk_", 4, names=["events", "customer"])
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in old:
        spark.conf.set(k, "-1")
    try:
        staged = filter_actions(T.user_visit_action(spark, loc, R.COND.start_date, R.COND.end_date),
                                T.user_info(spark, loc), R.COND)
        rows = sorted(map(tuple, staged.collect()))
        plan = staged._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and not re.search(r"Exchange hashpartitioning", plan)
    plain = filter_actions(T.user_visit_action(spark, sf, R.COND.start_date, R.COND.end_date),
                           T.user_info(spark, sf), R.COND)
    assert rows == sorted(map(tuple, plain.collect()))


def test_jdbc_failures_propagate(spark):
    """A failing write raises (no database is contacted: no driver
    exists for this URL, so the writer fails before connecting)."""
    import pytest

    df = spark.createDataFrame([("aaa--1", "3", 1, 2, 3)], schemas.CATEGORY_TOP10)
    with pytest.raises(Exception):
        jdbc.append(df, url="jdbc:nosuchdb://nowhere/report", table="category_top10")


def test_app_jdbc_writer_wiring(spark):
    """The offline app's JDBC writer passes its options through to the
    writer (and a failure surfaces)."""
    import pytest

    from shoplens import apps

    write = apps.jdbc_writer(url="jdbc:nosuchdb://nowhere/report", user="u", password="p", driver=None)
    df = spark.createDataFrame([("aaa--1", "3", 1, 2, 3)], schemas.CATEGORY_TOP10)
    with pytest.raises(Exception):
        write("category_top10", df)
