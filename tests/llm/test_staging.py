"""Small staged tables go to few files, whatever the number of partitions."""

import glob

import pytest

import corpus_pipeline
from shoplens.llm import common, pii


@pytest.fixture
def files(spark, tmp_path, monkeypatch):
    """Names of the staged tables and how many files each has; many shuffle
    partitions that Spark doesn't join."""
    monkeypatch.setattr(common, "shared_folder", lambda spark: f"file://{tmp_path}")
    changed = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield lambda: [(d.rsplit("/", 1)[1], len(glob.glob(f"{d}/part-*"))) for d in glob.glob(f"{tmp_path}/llm-*/*")]
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_file_for_so_many_rows(spark, files, monkeypatch):
    monkeypatch.setattr(common, "FILE_ROWS", 10)
    rows = spark.range(0, 45).repartition(12, "id")
    assert sorted(r.id for r in common.stage(rows, "few", 45).collect()) == list(range(45))
    assert sorted(r.id for r in common.stage(rows, "many").collect()) == list(range(45))
    assert [n <= 5 for name, n in sorted(files())] == [True, False]


def test_personal_data_is_staged_in_few_files(spark, files):
    texts = [f"key ref=ABCD{i:06d}xyz and password=hunter{i}" for i in range(300)]
    found = pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert all(r.spans for r in found.collect())
    assert {"edges", "marks", "found", "spans"} <= {name for name, _ in files()}
    assert max(n for name, n in files() if name != "pii") == 1


def test_components_are_staged_in_few_files(spark, files):
    edges = [(a, a + 2) for a in range(0, 2000, 2)] + [(a, a + 2) for a in range(1, 801, 2)]
    found = common.components(spark.createDataFrame(edges, "a bigint, b bigint"), len(edges))
    assert {(r.node, r.component) for r in found.collect()} == {(v, v % 2) for e in edges for v in e}
    assert max(n for _, n in files()) == 1


def test_near_duplicates_are_staged_in_few_files(spark, files):
    docs = [(i, " ".join(f"w{(i // 2, k)}" for k in range(40)) + f" x{i}") for i in range(200)]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 200, 2))
    few = {"heads", "buckets", "edges", "near", "found", "mixed", "named", "kept"}
    assert max(n for name, n in files() if name in few) <= 2
