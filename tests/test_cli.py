"""The command line, run in-process on the test session."""

import json
import os

from shoplens.__main__ import main
from shoplens.streaming import ads_app, word_count

SF = "/root/testdata/sf0.001"


def test_cli_offline(spark, scratch):
    cond = f"{scratch}/conditions.properties"
    with open(cond, "w") as f:
        f.write('condition.params.json={startDate:"2024-01-03", \\\n endDate:"2024-01-28", startAge: "20", '
                'endAge: "50", professionals: "", targetPageFlow:"1,2,3,4,5,6,7"}\n')
    assert main(["offline", "--tables", SF, "--conditions", cond, "--table-prefix", "cli_",
                 "--task-id", "aaa--7"], spark=spark) == 0
    assert spark.table("cli_category_top10").count() == 10
    assert {r.task_id for r in spark.table("cli_jump_page_ratio").collect()} == {"aaa--7"}
    # the adaptive session split gives the same page-jump table
    assert main(["offline", "--tables", SF, "--conditions", cond, "--table-prefix", "cli_auto_",
                 "--task-id", "aaa--7"], spark=spark) == 0
    assert sorted(spark.table("cli_auto_jump_page_ratio").collect()) == sorted(spark.table("cli_jump_page_ratio").collect())


def test_cli_wordcount_and_realtime(spark, scratch):
    root = f"{scratch}/cli"
    os.makedirs(f"{root}/words")
    with open(f"{root}/words/a.txt", "w") as f:
        f.write("a b a\n")
    assert main(["wordcount", "--snapshot", f"{root}/wc", "--input", f"{root}/words", "--available-now"],
                spark=spark) == 0
    assert {r.word: r.n for r in word_count.read_word_counts(spark, f"{root}/wc").collect()} == {"a": 2, "b": 1}

    os.makedirs(f"{root}/ads")
    t0 = 1704067200000
    with open(f"{root}/ads/a.txt", "w") as f:
        f.write("\n".join(f"{t0 + i * 1000} AREA C1 u{i % 2} {i % 3}" for i in range(9)) + "\n")
    assert main(["realtime", "--root", f"{root}/rt", "--input", f"{root}/ads", "--available-now",
                 "--threshold", "100"], spark=spark) == 0
    kv, top = ads_app.read_area_counts(spark, f"{root}/rt/snapshots")
    assert sum(int(r.value) for r in kv.collect()) == 9
    assert json.loads(top.first().value) == [{"0": 3}, {"1": 3}, {"2": 3}]
