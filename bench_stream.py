"""Streaming throughput of the ad pipeline (Q5 ban filter, Q6/Q7 counts,
Q8 window) and the word count (Q9) over the ad clicks of $BENCH_SF_DIR,
written in time order as wire lines into $BENCH_STREAM_FILES files (one
micro-batch each).

Prints one JSON line with seconds, rows/s and micro-batches per query.
Scratch data goes to a fresh folder under /tmp (local benchmark only).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from shoplens.session import get_session  # noqa: E402
from shoplens.sources import tables as T  # noqa: E402
from shoplens.streaming import ads_app, sources, word_count  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    n_files = int(os.environ.get("BENCH_STREAM_FILES", "10"))
    scratch = tempfile.mkdtemp(prefix="shoplens-stream-bench-", dir="/tmp")
    spark = get_session(
        master=f"local[{cpus}]",
        app_name="shoplens-stream-bench",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        extra={"spark.checkpoint.dir": f"{scratch}/checkpoints"},
    )
    ads = T.ads_log(spark, sf_dir)
    # arrival order = time order: the clicks cut into n_files contiguous time
    # ranges, as a live stream would deliver them
    lines = T.ads_lines(ads, keep=("event_id", "timestamp"))
    (lines.repartitionByRange(n_files, "timestamp").sortWithinPartitions("timestamp").select("value")
     .write.text(f"{scratch}/staging"))
    staged = sorted(p for p in os.listdir(f"{scratch}/staging") if p.startswith("part-"))
    os.makedirs(f"{scratch}/in")
    for i, name in enumerate(staged):
        dst = f"{scratch}/in/{i:05d}.txt"
        os.link(f"{scratch}/staging/{name}", dst)
        os.utime(dst, (1000 + i, 1000 + i))
    n_rows = ads.count()
    once = {"availableNow": True}
    out = {}

    def timed(name, start):
        t0 = time.perf_counter()
        q = start()
        q.awaitTermination()
        sec = time.perf_counter() - t0
        batches = sum(1 for p in q.recentProgress if p["numInputRows"] > 0)
        out[name] = {"sec": round(sec, 3), "rows_per_sec": round(n_rows / sec), "batches": batches}

    src = lambda: sources.text_file_stream(spark, f"{scratch}/in", max_files_per_trigger=1)
    timed("q5_ban_filter", lambda: ads_app.start_ban_filter(src(), f"{scratch}/filtered", 100, trigger=once))
    filtered = lambda: ads_app.read_filtered(spark, f"{scratch}/filtered", max_files_per_trigger=8)
    timed("q6_area_counts", lambda: ads_app.start_area_counts(filtered(), f"{scratch}/snap", trigger=once))
    timed("q7_top_ads", lambda: ads_app.start_top_ads(filtered(), f"{scratch}/snap", trigger=once))
    timed("q8_window_clicks", lambda: ads_app.start_window_clicks(filtered(), f"{scratch}/snap", trigger=once))
    timed("q9_word_count", lambda: word_count.start_word_count(src(), f"{scratch}/words", trigger=once))
    print(json.dumps({"metric": "stream_sec", "value": round(sum(v["sec"] for v in out.values()), 3),
                      "unit": "sec", "rows": n_rows, "files": n_files, "queries": out}))
    spark.stop()


if __name__ == "__main__":
    main()
