"""Streaming jobs run over the test clicks split into files of three days
(``maxFilesPerTrigger=1`` -> one micro-batch per file) and compared with the
batch forms; plus restart-from-checkpoint and marker-file stop.  (The
registered ``ads_after_ban`` oracle is the one-day-per-batch case.)"""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from shoplens.plans import ads as A
from shoplens.sources import tables as T
from shoplens.streaming import ads_app, ban_filter, control, offsets, sources, word_count

SF = "/root/testdata/sf0.01"
THRESHOLD = 3
AVAILABLE_NOW = {"availableNow": True}


DAYS_PER_BATCH = 3


def _batch_of(date: str) -> int:
    """Micro-batch index of a day: the test clicks span January 2024."""
    return (int(date[-2:]) - 1) // DAYS_PER_BATCH


def _write_batch_files(spark, folder):
    """One text file of wire lines per group of DAYS_PER_BATCH days,
    modification times in order (the file source takes the oldest first)."""
    ads = T.ads_log(spark, SF).withColumn("date", F.date_format("ts", "yyyy-MM-dd"))
    rows = T.ads_lines(ads, keep=("date", "event_id")).orderBy("date", "event_id").collect()
    by_batch = {}
    for r in rows:
        by_batch.setdefault(_batch_of(r.date), []).append(r.value)
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 10_000
    for b, lines in sorted(by_batch.items()):
        p = os.path.join(folder, f"ads-{b:03d}.txt")
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (base + b, base + b))
    return len(by_batch)


def _arriving(lines):
    """A replay: every click came at its own time."""
    return lines.withColumn("arrival", F.substring_index("value", " ", 1).cast("bigint"))


@pytest.fixture(scope="module")
def stream_run(spark, scratch):
    root = f"{scratch}/ads_stream"
    n_batches = _write_batch_files(spark, f"{root}/in")
    lines = _arriving(sources.text_file_stream(spark, f"{root}/in", max_files_per_trigger=1))
    q1 = ads_app.start_ban_filter(lines, f"{root}/filtered", THRESHOLD,
                                  checkpoint=f"{root}/ck1", trigger=AVAILABLE_NOW)
    q1.awaitTermination()
    batches = q1.recentProgress

    def filtered():
        return ads_app.read_filtered(spark, f"{root}/filtered", max_files_per_trigger=40)

    for q in (
        ads_app.start_area_counts(filtered(), f"{root}/snap", checkpoint=f"{root}/ck2", trigger=AVAILABLE_NOW),
        ads_app.start_area_counts(filtered(), f"{root}/snap_wm", checkpoint=f"{root}/ck2w", trigger=AVAILABLE_NOW,
                                  name="ads_area_counts_wm", watermark="40 days"),
        ads_app.start_top_ads(filtered(), f"{root}/snap", checkpoint=f"{root}/ck2t", trigger=AVAILABLE_NOW),
        ads_app.start_top_ads(filtered(), f"{root}/snap_wm", checkpoint=f"{root}/ck2tw", trigger=AVAILABLE_NOW,
                              name="ads_top_ads_wm", watermark="40 days"),
        ads_app.start_window_clicks(filtered(), f"{root}/snap", window_minutes=60,
                                    checkpoint=f"{root}/ck3", trigger=AVAILABLE_NOW),
    ):
        q.awaitTermination()
    return {"root": root, "n_batches": n_batches, "batches": batches}


def _expected_kept(spark):
    """Closed form with DAYS_PER_BATCH-day micro-batches: a user's clicks are
    kept up to and including the batch holding their first ban day."""
    ads = A.with_date(T.ads_log(spark, SF))
    bans = A.ban_list(ads, THRESHOLD)
    batch = F.floor((F.dayofmonth(F.to_date("date")) - 1) / DAYS_PER_BATCH)
    ban_batch = F.floor((F.dayofmonth(F.to_date("ban_date")) - 1) / DAYS_PER_BATCH)
    return ads.join(bans, "userid", "left").filter(F.col("ban_date").isNull() | (batch <= ban_batch))


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_ban_stream_matches_closed_form(spark, stream_run):
    root = stream_run["root"]
    assert len([b for b in stream_run["batches"] if b["numInputRows"] > 0]) == stream_run["n_batches"]
    out = spark.read.parquet(f"{root}/filtered")
    ads = T.ads_log(spark, SF)
    assert _set(ban_filter.bans(out)) == _set(A.ban_list(ads, THRESHOLD))
    kept = ban_filter.kept_clicks(out)
    want = _expected_kept(spark)
    cols = ["timestamp", "userid", "adid"]
    assert kept.count() == want.count()
    assert _set(kept.select(cols)) == _set(want.select(cols))


def test_running_counts_and_top_ads(spark, stream_run):
    root = stream_run["root"]
    counts = A.date_area_city_ad_count(_expected_kept(spark))
    kv, top = ads_app.read_area_counts(spark, f"{root}/snap")
    assert _set(kv) == _set(A.date_area_city_ad_kv(counts))
    assert _set(top) == _set(A.top_ads_kv(A.date_area_top_ads(counts)))
    # with a watermark the published tables are the same
    kv_wm, top_wm = ads_app.read_area_counts(spark, f"{root}/snap_wm")
    assert _set(kv_wm) == _set(kv) and _set(top_wm) == _set(top)


def test_window_clicks(spark, stream_run):
    root = stream_run["root"]
    kept = _expected_kept(spark).drop("date", "ban_date")
    rows, per_ad = ads_app.read_window(spark, f"{root}/snap")
    assert _set(rows) == _set(A.last_window_ad_clicks(kept, 60))
    assert _set(per_ad) == _set(A.last_window_ad_clicks_json(kept, 60))


def test_ban_timing_small(spark, scratch):
    """threshold 3: batch 1 has 3 clicks of u on ad a -> all kept, u banned;
    batch 2 (a click of u on ad b) is dropped."""
    root = f"{scratch}/ban_small"
    os.makedirs(f"{root}/in")
    t0 = 1704067200000
    batches = [[f"{t0 + i} A c u a" for i in range(3)] + [f"{t0} A c w a"], [f"{t0 + 10} A c u b", f"{t0 + 11} A c w a"]]
    for i, lines in enumerate(batches):
        p = f"{root}/in/b{i}.txt"
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (1000 + i, 1000 + i))
    lines = sources.text_file_stream(spark, f"{root}/in", max_files_per_trigger=1)
    q = ads_app.start_ban_filter(lines, f"{root}/out", 3, checkpoint=f"{root}/ck", trigger=AVAILABLE_NOW)
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    assert ban_filter.kept_clicks(out).filter("userid = 'u'").count() == 3
    assert ban_filter.kept_clicks(out).filter("userid = 'w'").count() == 2
    assert [r.userid for r in ban_filter.bans(out).collect()] == ["u"]


def test_word_count_restart_and_marker_stop(spark, scratch):
    root = f"{scratch}/words"
    os.makedirs(f"{root}/in")

    def add(name, text, t):
        p = f"{root}/in/{name}"
        with open(p, "w") as f:
            f.write(text)
        os.utime(p, (t, t))

    add("1.txt", "a a b\n", 1000)
    lines = sources.text_file_stream(spark, f"{root}/in", max_files_per_trigger=1)
    q = word_count.start_word_count(lines, f"{root}/snap", checkpoint=f"{root}/ck", trigger=AVAILABLE_NOW)
    q.awaitTermination()
    got = {r.word: r.n for r in word_count.read_word_counts(spark, f"{root}/snap").collect()}
    assert got == {"a": 2, "b": 1}
    # restart from the checkpoint: state is restored, only the new file is read
    add("2.txt", "a\n", 2000)
    lines = sources.text_file_stream(spark, f"{root}/in", max_files_per_trigger=1)
    q = word_count.start_word_count(lines, f"{root}/snap", checkpoint=f"{root}/ck", trigger=AVAILABLE_NOW)
    q.awaitTermination()
    got = {r.word: r.n for r in word_count.read_word_counts(spark, f"{root}/snap").collect()}
    assert got == {"a": 3, "b": 1}
    # a continuously running query stops when the marker file appears
    lines = sources.text_file_stream(spark, f"{root}/in", max_files_per_trigger=1)
    q = word_count.start_word_count(lines, f"{root}/snap", checkpoint=f"{root}/ck",
                                    trigger={"processingTime": "200 milliseconds"})
    marker = f"{root}/STOP"
    threading.Timer(1.5, lambda: open(marker, "w").close()).start()
    why = control.run_until_marker(spark, q, marker, poll_seconds=0.5, timeout=60)
    assert why == "marker" and not q.isActive


def test_kafka_options():
    o = sources.kafka_options("h:9092", ["ads_log"], group_id="g", starting_offsets={"ads_log": {0: 5, 1: 7}},
                              max_offsets_per_trigger=1000)
    assert o["subscribe"] == "ads_log" and o["kafka.group.id"] == "g"
    assert o["startingOffsets"] == '{"ads_log": {"0": 5, "1": 7}}'
    assert o["maxOffsetsPerTrigger"] == "1000"


def test_batch_end_offsets(spark):
    df = spark.createDataFrame([("t", 0, 5), ("t", 0, 9), ("t", 1, 3)], "topic string, partition int, offset long")
    got = {(r.topic, r.partition): r.until_offset for r in sources.batch_end_offsets(df).collect()}
    assert got == {("t", 0): 10, ("t", 1): 4}


def test_offsets_published_with_results(spark, scratch):
    root = f"{scratch}/offsets"
    assert offsets.starting_offsets(spark, root) == "earliest"
    publish = offsets.publish_with_offsets(root, lambda b: A.running_word_count(b))
    b0 = spark.createDataFrame([("a b", "t", 0, 10), ("a", "t", 1, 3)], "value string, topic string, partition int, offset long")
    b1 = spark.createDataFrame([("b", "t", 0, 11)], "value string, topic string, partition int, offset long")
    publish(b0, 0)
    publish(b1, 1)
    publish(b1, 1)  # a replayed batch adds nothing
    assert offsets.starting_offsets(spark, root) == '{"t": {"0": 12, "1": 4}}'
    assert {r.word: r.n for r in offsets.results(spark, root).collect()} == {"b": 1}


def test_offsets_go_on_with_a_new_checkpoint(spark, scratch):
    """Five batches, a new checkpoint whose source brings everything again and
    then more: offsets advance, nothing is counted twice."""
    root = f"{scratch}/offsets_restart"
    record = "value string, topic string, partition int, offset long"

    def add_up(before, new):
        rows = new if before is None else before.unionByName(new)
        return rows.groupBy("word").agg(F.sum("n").alias("n"))

    publish = offsets.publish_with_offsets(root, lambda b: A.running_word_count(b), add_up)

    def write(first, last):
        for i in range(first, last):
            rows = [(f"w{i % 3} x", "t", i % 2, i // 2)]
            spark.createDataFrame(rows, record).coalesce(1).write.mode("append").parquet(f"{root}_in")
            time.sleep(0.05)

    def run(checkpoint):
        stream = spark.readStream.schema(record).option("maxFilesPerTrigger", 1).parquet(f"{root}_in")
        q = stream.writeStream.foreachBatch(publish).option("checkpointLocation", f"{root}_{checkpoint}")
        q = q.trigger(**AVAILABLE_NOW).start()
        q.awaitTermination()
        return len([p for p in q.recentProgress if p["numInputRows"]])

    write(0, 5)
    assert run("ck1") == 5
    assert offsets.starting_offsets(spark, root) == '{"t": {"0": 3, "1": 2}}'
    first = {r.word: r.n for r in offsets.results(spark, root).collect()}
    assert first == {"w0": 2, "w1": 2, "w2": 1, "x": 5}
    write(5, 7)
    assert run("ck2") == 7  # the source starts at the earliest record
    assert offsets.starting_offsets(spark, root) == '{"t": {"0": 4, "1": 3}}'
    assert {r.word: r.n for r in offsets.results(spark, root).collect()} == {"w0": 3, "w1": 2, "w2": 2, "x": 7}


def test_stop_on_signal(spark, scratch):
    import signal as _signal

    root = f"{scratch}/sig"
    os.makedirs(f"{root}/in")
    with open(f"{root}/in/a.txt", "w") as f:
        f.write("x y\n")
    lines = sources.text_file_stream(spark, f"{root}/in")
    q = word_count.start_word_count(lines, f"{root}/snap", checkpoint=f"{root}/ck",
                                    trigger={"processingTime": "200 milliseconds"})
    old = {s: _signal.getsignal(s) for s in (_signal.SIGTERM, _signal.SIGINT)}
    try:
        handler = control.stop_on_signal([q])
        q.processAllAvailable()
        handler(_signal.SIGTERM, None)
        assert not q.isActive
    finally:
        for s, h in old.items():
            _signal.signal(s, h)
    got = {r.word: r.n for r in word_count.read_word_counts(spark, f"{root}/snap").collect()}
    assert got == {"x": 1, "y": 1}


def test_pipeline_restart_matches_closed_form(spark, scratch):
    """Stop after half of the files, restart from the checkpoints with the
    rest: ban state, kept clicks and published counts come out as if run
    once (state store and sink commit logs restored)."""
    root = f"{scratch}/restart"
    staged = f"{root}/staged"
    _write_batch_files(spark, staged)
    names = sorted(os.listdir(staged))
    os.makedirs(f"{root}/in")

    def run_once():
        lines = sources.text_file_stream(spark, f"{root}/in", max_files_per_trigger=1)
        q = ads_app.start_ban_filter(lines, f"{root}/filtered", THRESHOLD, checkpoint=f"{root}/ck1",
                                     trigger=AVAILABLE_NOW)
        q.awaitTermination()
        q = ads_app.start_area_counts(ads_app.read_filtered(spark, f"{root}/filtered"), f"{root}/snap",
                                      checkpoint=f"{root}/ck2", trigger=AVAILABLE_NOW)
        q.awaitTermination()

    for part in (names[: len(names) // 2], names[len(names) // 2:]):
        for n in part:
            os.link(f"{staged}/{n}", f"{root}/in/{n}")
            st = os.stat(f"{staged}/{n}")
            os.utime(f"{root}/in/{n}", (st.st_mtime, st.st_mtime))
        run_once()
    out = spark.read.parquet(f"{root}/filtered")
    want = _expected_kept(spark)
    cols = ["timestamp", "userid", "adid"]
    assert _set(ban_filter.kept_clicks(out).select(cols)) == _set(want.select(cols))
    assert _set(ban_filter.bans(out)) == _set(A.ban_list(T.ads_log(spark, SF), THRESHOLD))
    kv, _ = ads_app.read_area_counts(spark, f"{root}/snap")
    assert _set(kv) == _set(A.date_area_city_ad_kv(A.date_area_city_ad_count(want)))


def test_ban_counters_can_forget_old_days(spark, scratch):
    """count_days=1: a day's counter is dropped once the user has clicks two
    days later; same-day clicks still ban."""
    root = f"{scratch}/ban_days"
    os.makedirs(f"{root}/in")
    day = 86_400_000
    t0 = 1704067200000
    batches = [[f"{t0} A c u a", f"{t0 + 1} A c u a"],          # day 1: 2 clicks on a
               [f"{t0 + 2 * day} A c u b"],                      # day 3: day 1 counter dropped
               [f"{t0 + 5} A c u a"],                            # late day-1 click: counter restarts at 1
               [f"{t0 + 2 * day + i} A c u b" for i in range(1, 3)]]  # day 3: b reaches 3 -> ban
    for i, lines in enumerate(batches):
        p = f"{root}/in/b{i}.txt"
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (1000 + i, 1000 + i))
    lines = sources.text_file_stream(spark, f"{root}/in", max_files_per_trigger=1)
    q = ads_app.start_ban_filter(lines, f"{root}/out", 3, checkpoint=f"{root}/ck", trigger=AVAILABLE_NOW,
                                 count_days=1)
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    assert [r.ban_date for r in ban_filter.bans(out).collect()] == ["2024-01-03"]
    assert ban_filter.kept_clicks(out).count() == 6


def test_batch_replay_equals_day_closed_form(spark):
    ads = A.with_date(T.ads_log(spark, SF))
    by_day = A.ads_after_ban_by_batch(ads.withColumn("b", F.col("date")), "b", THRESHOLD)
    assert _set(by_day.select("event_id")) == _set(A.ads_after_ban(ads, THRESHOLD).select("event_id"))
    bans = A.ban_list_by_batch(ads.withColumn("b", F.col("date")), "b", THRESHOLD).select("userid", "ban_date")
    assert _set(bans) == _set(A.ban_list(ads, THRESHOLD))


def test_stream_with_batches_spanning_days(spark, scratch):
    """Files of 1,500 clicks in time order: micro-batches cut through days.
    The stream keeps exactly what the batch replay says."""
    root = f"{scratch}/span"
    os.makedirs(f"{root}/in")
    ads = T.ads_log(spark, SF)
    rows = T.ads_lines(ads, keep=("event_id", "timestamp")).orderBy("timestamp", "event_id").collect()
    size = 1500
    batch_of = {}
    for i in range(0, len(rows), size):
        chunk = rows[i:i + size]
        p = f"{root}/in/{i // size:04d}.txt"
        with open(p, "w") as f:
            f.write("\n".join(r.value for r in chunk) + "\n")
        os.utime(p, (1000 + i // size, 1000 + i // size))
        batch_of.update({r.event_id: i // size for r in chunk})
    lines = sources.text_file_stream(spark, f"{root}/in", max_files_per_trigger=1)
    q = ads_app.start_ban_filter(lines, f"{root}/out", THRESHOLD, checkpoint=f"{root}/ck", trigger=AVAILABLE_NOW)
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    batches = spark.createDataFrame(list(batch_of.items()), "event_id long, b long")
    want = A.ads_after_ban_by_batch(ads.join(batches, "event_id"), "b", THRESHOLD)
    cols = ["timestamp", "userid", "adid"]
    assert _set(ban_filter.kept_clicks(out).select(cols)) == _set(want.select(cols))
    assert _set(ban_filter.bans(out)) == _set(
        A.ban_list_by_batch(ads.join(batches, "event_id"), "b", THRESHOLD).select("userid", "ban_date")
    )


def test_stream_readers_without_a_broker_or_port(spark):
    """Defining the socket stream opens no connection (that happens when a
    query starts, which this test never does); the Kafka reader needs the
    connector jar, which plain PySpark lacks, and says so."""
    import pytest

    lines = sources.socket_stream(spark, "localhost", 9)
    assert lines.isStreaming and lines.columns == ["value"]
    with pytest.raises(Exception, match="(?i)kafka"):
        sources.kafka_stream(spark, bootstrap_servers="localhost:9092", topics="ads_log")


def _files(folder, batches):
    os.makedirs(folder, exist_ok=True)
    for i, lines in enumerate(batches):
        p = f"{folder}/b{i:03d}.txt"
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (1000 + i, 1000 + i))


def test_ban_filter_has_no_python_on_clicks_and_replays(spark, scratch, monkeypatch):
    """A batch that died before its commit is done again, one that died after
    it is only moved into view; bans outlive a new checkpoint."""
    root = f"{scratch}/ban_replay"
    state = ban_filter.BanFilter(spark, root, 3)
    t0 = 1704067200000
    clicks = lambda rows: A.parse_ads_lines(ads_app.stamped(spark.createDataFrame([(r,) for r in rows], "value string")))
    first = clicks([f"{t0 + i} A c u a" for i in range(3)] + [f"{t0} A c w a"])
    plans = []
    write = ban_filter.BanFilter._keep

    def keep(self, batch, bans, path):
        plans.append(batch.join(bans, "userid", "left_anti")._jdf.queryExecution().toString())
        write(self, batch, bans, path)

    monkeypatch.setattr(ban_filter.BanFilter, "_keep", keep)
    commit = state.log.commit

    def die(*_, **__):
        raise RuntimeError("driver lost")

    state.log.commit = die
    with pytest.raises(RuntimeError):
        state.process(first, 0)
    assert not any(n.startswith("epoch=") for n in os.listdir(root))
    state.log.commit = commit
    with monkeypatch.context() as m:
        m.setattr(ban_filter.BanFilter, "settle", lambda *_: None)  # dies between commit and move
        state.process(first, 0)
    assert not any(n.startswith("epoch=") for n in os.listdir(root))
    state.process(first, 0)  # replayed: moved into view, nothing added
    assert ban_filter.kept_clicks(spark.read.parquet(root)).count() == 4
    other = ban_filter.BanFilter(spark, root, 3)  # a new driver
    other.process(clicks([f"{t0 + 9} A c u b", f"{t0 + 9} A c w a", f"{t0 + 9} A c w a"]), 1)
    assert sorted(r.userid for r in other.bans().collect()) == ["u", "w"]
    assert ban_filter.kept_clicks(spark.read.parquet(root)).filter("userid = 'u'").count() == 3
    assert {(r.userid, r.adid): r.cnt for r in other.counts().collect()} == {("u", "a"): 3, ("w", "a"): 3}
    assert plans and not any("Python" in p or "InPandas" in p for p in plans)


def test_ban_state_stays_small(spark, scratch):
    """Segments are merged, whatever the number of batches; a user without
    id is a user; old files go."""
    root = f"{scratch}/ban_segments"
    state = ban_filter.BanFilter(spark, root, 100, keep_seconds=0)
    for i in range(20):
        rows = [(1704067200000 + i, "A", "c", u, "a", 0) for u in ("u", None)]
        df = spark.createDataFrame(rows, "timestamp long, area string, city string, userid string, adid string, arrival long")
        state.process(df, i)
    assert {r.userid: r.cnt for r in state.counts().collect()} == {"u": 20, None: 20}
    body = state.log.latest().body
    assert len(body["counts"]) < 8
    state.log.expire()
    assert len(os.listdir(f"{root}/_state/data")) <= len(body["counts"]) + len(body["bans"])


def test_a_click_ten_years_ahead_changes_nothing_else(spark, scratch):
    root = f"{scratch}/ahead"
    t0, minute = 1704067200000, 60_000
    year = 365 * 86_400_000
    rows = [(t0 + i * minute, t0 + i * minute, "a") for i in range(4)] + [(t0 + 10 * year, t0 + minute, "a"), (t0, t0 + 3 * minute, "b")]

    def published(rows, name):
        _files(f"{root}/{name}/in", [[f"{a} {t} A c u{i} {ad}"] for i, (t, a, ad) in enumerate(sorted(rows, key=lambda r: r[1]))])
        raw = sources.text_file_stream(spark, f"{root}/{name}/in", max_files_per_trigger=2)
        lines = raw.select(
            F.substring_index("value", " ", 1).cast("bigint").alias("arrival"),
            F.expr("substring(value, instr(value, ' ') + 1)").alias("value"),
        )
        out = f"{root}/{name}/out"
        ads_app.start_ban_filter(lines, out, 100, checkpoint=f"{root}/{name}/ck1", trigger=AVAILABLE_NOW).awaitTermination()
        ads_app.start_window_clicks(ads_app.read_filtered(spark, out), f"{root}/{name}/snap", 60,
                                    checkpoint=f"{root}/{name}/ck2", trigger=AVAILABLE_NOW).awaitTermination()
        return _set(ads_app.read_window(spark, f"{root}/{name}/snap")[0]), _set(ads_app.read_ahead(spark, f"{root}/{name}/snap"))

    with_it, ahead = published(rows, "with")
    without, none = published([r for r in rows if r[0] < t0 + year], "without")
    assert with_it == without and len(without) == 5
    assert ahead == [("a", 1)] and none == []
    batch = spark.createDataFrame(rows, "timestamp long, arrival long, adid string")
    assert _set(A.last_window_ad_clicks(batch, 60)) == without
    assert _set(A.clicks_ahead(batch)) == ahead
    assert _set(A.last_window_ad_clicks(batch, 2)) == [("a", "00:02", 1), ("a", "00:03", 1), ("b", "00:00", 1)]


def test_top_ads_write_only_groups_that_change(spark, scratch):
    schema = "date string, area string, adid string, cnt long"
    table = ads_app.top_ads_table(spark, f"{scratch}/top_unit")

    def update(rows):
        new = ads_app.next_top(table.read(), spark.createDataFrame(rows, schema), 2)
        written = {(r.date, r.area): [(t.adid, t.cnt) for t in r.top] for r in new.collect()}
        table.upsert(new)
        return written

    assert update([("d", "x", "a", 5), ("d", "x", "b", 3), ("d", "x", "c", 1), ("d", None, "a", 1)]) == {
        ("d", "x"): [("a", 5), ("b", 3)], ("d", None): [("a", 1)]}
    assert update([("d", "x", "c", 2)]) == {}  # still third
    assert update([("d", "x", "c", 3), ("d", None, "b", 1)]) == {("d", None): [("a", 1), ("b", 1)]}  # a tie goes to b
    assert update([("d", "x", "c", 9), ("e", "x", "a", 1)]) == {("d", "x"): [("c", 9), ("a", 5)], ("e", "x"): [("a", 1)]}
    got = {(r.date, r.area): [t.adid for t in r.top] for r in table.read().collect()}
    assert got == {("d", "x"): ["c", "a"], ("d", None): ["a", "b"], ("e", "x"): ["a"]}


def test_marker_stops_publishers_after_the_ban_filter_is_worked_off(spark, scratch):
    """The marker appears in mid-stream: what the ban filter let through by
    then is in the published counts, although the publishers run slower."""
    from shoplens import apps

    root = f"{scratch}/barrier"
    t0 = 1704067200000
    _files(f"{root}/in", [[f"{t0 + i} A c u{i % 7} a{i % 3}" for i in range(k, k + 50)] for k in range(0, 600, 50)])
    lines = sources.text_file_stream(spark, f"{root}/in", max_files_per_trigger=1)
    q_ban = ads_app.start_ban_filter(lines, f"{root}/filtered", 1000, checkpoint=f"{root}/ck",
                                     trigger={"processingTime": "100 milliseconds"})
    downstream = apps.start_realtime_publishers(spark, root, trigger={"processingTime": "4 seconds"})
    marker = f"{root}/STOP"
    threading.Timer(4.0, lambda: open(marker, "w").close()).start()
    why = control.run_all(spark, [q_ban], marker, poll_seconds=0.2, downstream=downstream)
    assert why == "marker" and not any(q.isActive for q in [q_ban, *downstream])
    kept = ban_filter.kept_clicks(spark.read.parquet(f"{root}/filtered"))
    assert kept.count() > 0
    kv, _ = ads_app.read_area_counts(spark, f"{root}/snapshots")
    assert _set(kv) == _set(A.date_area_city_ad_kv(A.date_area_city_ad_count(kept)))
