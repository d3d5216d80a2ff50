"""Command line for the applications.

  python -m shoplens offline  --tables DIR [--conditions FILE] [--table-prefix P | --jdbc-url URL ...]
  python -m shoplens stage    --tables DIR --prefix P --buckets N   (then --tables catalog:P)
  python -m shoplens realtime --root DIR (--input DIR | --kafka HOST:PORT --topic T) [--threshold N]
  python -m shoplens wordcount --snapshot DIR (--input DIR | --socket HOST:PORT) [--stop-marker PATH]

Checkpoints go under the session's ``spark.checkpoint.dir`` (pass it with
``--conf spark.checkpoint.dir=...`` to spark-submit).
"""

from __future__ import annotations

import argparse
import sys

from shoplens import apps, params
from shoplens.functions import constants as K
from shoplens.session import get_session
from shoplens.sources import tables
from shoplens.streaming import control, sources, word_count


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="shoplens")
    p.add_argument("--cluster", action="store_true", help="use the settings for a large cluster")
    sub = p.add_subparsers(dest="cmd", required=True)

    off = sub.add_parser("offline", help="Q1-Q4 report")
    off.add_argument("--tables", required=True, help="folder with the input Parquet tables")
    off.add_argument("--conditions", help="conditions file (JSON, keys may be unquoted)")
    off.add_argument("--task-id")
    off.add_argument("--table-prefix", default="", help="write results as catalog tables")
    off.add_argument("--jdbc-url", help="append results over JDBC instead")
    off.add_argument("--jdbc-user")
    off.add_argument("--jdbc-password")
    off.add_argument("--jdbc-driver")

    st = sub.add_parser("stage", help="copy the input tables into the catalog, user-keyed ones bucketed")
    st.add_argument("--tables", required=True)
    st.add_argument("--prefix", required=True)
    st.add_argument("--buckets", type=int, required=True)

    rt = sub.add_parser("realtime", help="Q5-Q8 streaming pipeline")
    rt.add_argument("--root", required=True, help="shared folder for the filtered clicks and snapshots")
    rt.add_argument("--input", help="folder of text files with ad-click lines")
    rt.add_argument("--kafka", help="bootstrap servers")
    rt.add_argument("--topic", default="ads_log")
    rt.add_argument("--threshold", type=int, default=K.BAN_THRESHOLD)
    rt.add_argument("--window-minutes", type=int, default=K.AD_WINDOW_MINUTES)
    rt.add_argument("--trigger-seconds", type=float, default=3.0)
    rt.add_argument("--state-watermark", help='evict running-count state of older days, e.g. "2 days"')
    rt.add_argument("--count-days", type=int, help="keep daily ban counters for this many days")
    rt.add_argument("--stop-marker", help="stop gracefully when this path appears")
    rt.add_argument("--available-now", action="store_true", help="process what is there, then stop")

    wc = sub.add_parser("wordcount", help="Q9 running word count")
    wc.add_argument("--snapshot", required=True, help="folder for the published counts")
    wc.add_argument("--input", help="folder of text files")
    wc.add_argument("--socket", help="HOST:PORT")
    wc.add_argument("--trigger-seconds", type=float, default=3.0)
    wc.add_argument("--stop-marker")
    wc.add_argument("--available-now", action="store_true")
    return p


def _trigger(args) -> dict:
    if args.available_now:
        return {"availableNow": True}
    return {"processingTime": f"{args.trigger_seconds} seconds"}


def _wait(spark, queries, args, downstream=()) -> None:
    control.stop_on_signal(queries, downstream=downstream)
    control.run_all(spark, queries, args.stop_marker, downstream=downstream)


def main(argv=None, spark=None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or get_session(app_name=f"shoplens-{args.cmd}", cluster=args.cluster)
    if args.cmd == "offline":
        cond = params.DEFAULT
        if args.conditions:
            text = spark.read.text(args.conditions, wholetext=True).first()[0]  # any path Spark reads
            cond = params.Conditions.from_json(text)
        if args.jdbc_url:
            write = apps.jdbc_writer(
                url=args.jdbc_url, user=args.jdbc_user, password=args.jdbc_password, driver=args.jdbc_driver
            )
        else:
            write = apps.table_writer(args.table_prefix)
        task = apps.run_offline(spark, args.tables, write, cond, args.task_id)
        print(task)
        return 0
    if args.cmd == "stage":
        if spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "in-memory":
            raise SystemExit(
                "stage needs a persistent catalog (a Hive metastore or the cluster's catalog): "
                "tables staged in the in-memory catalog vanish with this session"
            )
        print(tables.stage_tables(spark, args.tables, args.prefix, args.buckets))
        return 0
    if args.cmd == "realtime":
        if args.kafka:
            lines = sources.kafka_stream(spark, bootstrap_servers=args.kafka, topics=args.topic)
        elif args.input:
            lines = sources.text_file_stream(spark, args.input)
        else:
            raise SystemExit("give --input or --kafka")
        queries = apps.start_realtime(
            lines, args.root, args.threshold, args.window_minutes, trigger=_trigger(args),
            state_watermark=args.state_watermark, count_days=args.count_days,
        )
        if args.available_now:
            # the publishers read the ban filter's output: run them again once it is complete
            queries[0].awaitTermination()
            for q in queries[1:]:
                q.awaitTermination()
            queries = apps.start_realtime_publishers(
                spark, args.root, args.window_minutes, trigger=_trigger(args),
                state_watermark=args.state_watermark,
            )
            _wait(spark, queries, args)
        else:
            _wait(spark, queries[:1], args, downstream=queries[1:])
        return 0
    if args.cmd == "wordcount":
        if args.socket:
            host, port = args.socket.rsplit(":", 1)
            lines = sources.socket_stream(spark, host, int(port))
        elif args.input:
            lines = sources.text_file_stream(spark, args.input)
        else:
            raise SystemExit("give --input or --socket")
        ck = f"{apps.pipeline_checkpoints(spark, args.snapshot)}/word_count"
        q = word_count.start_word_count(lines, args.snapshot, checkpoint=ck, trigger=_trigger(args))
        _wait(spark, [q], args)
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
