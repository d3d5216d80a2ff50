"""Shuffle bytes per headline job, from Spark's event log.

Runs each job once (noop sink) with the event log written to a fresh scratch
folder, then sums the tasks' shuffle write / read bytes per SQL execution.

    python tools/shuffle_bytes.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from shoplens import registry  # noqa: E402
from shoplens.session import get_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    logs = tempfile.mkdtemp(prefix="shoplens-eventlog-", dir="/tmp")
    spark = get_session(
        master="local[8]",
        shuffle_partitions=8,
        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logs, "spark.eventLog.compress": "false"},
    )
    queries = registry.queries()
    names = {}
    for name, key in HEADLINE.items():
        spark.sparkContext.setJobDescription(name)
        spark.sparkContext.setLocalProperty("shoplens.job", name)
        queries[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        names[name] = key
    spark.stop()

    job_of_stage, name_of_job = {}, {}
    totals = {n: {"shuffle_write_bytes": 0, "shuffle_read_bytes": 0, "stages": 0} for n in names}
    for path in sorted(glob.glob(f"{logs}/**/*", recursive=True)):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path, encoding="utf-8") as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    job = props.get("shoplens.job")
                    if job:
                        for sid in ev.get("Stage IDs", []):
                            job_of_stage[sid] = job
                elif kind == "SparkListenerStageCompleted":
                    sid = ev["Stage Info"]["Stage ID"]
                    if sid in job_of_stage:
                        totals[job_of_stage[sid]]["stages"] += 1
                elif kind == "SparkListenerTaskEnd":
                    job = job_of_stage.get(ev.get("Stage ID"))
                    metrics = ev.get("Task Metrics") or {}
                    if job:
                        w = metrics.get("Shuffle Write Metrics") or {}
                        r = metrics.get("Shuffle Read Metrics") or {}
                        totals[job]["shuffle_write_bytes"] += int(w.get("Shuffle Bytes Written", 0))
                        totals[job]["shuffle_read_bytes"] += int(r.get("Remote Bytes Read", 0)) + int(
                            r.get("Local Bytes Read", 0)
                        )
    print(json.dumps({"sf_dir": sf_dir, "event_log": logs, "jobs": totals}, indent=1))


if __name__ == "__main__":
    main(sys.argv)
