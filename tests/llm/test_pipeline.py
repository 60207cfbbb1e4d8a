"""The pipeline's stages on small tables with every odd row: each stage's decisions by the operators' own brute force."""

import pytest
from tests_llm_data import EDGE, prose

import corpus_pipeline as P
from starmart.llm import decontam, quality, simhash
from starmart.llm.common import DOC_COLUMNS, DOCUMENTS

ITEM = prose(77, 40)


@pytest.fixture
def folder(spark, tmp_path):
    def make(docs, labels=(), items=()):
        spark.createDataFrame(list(docs), DOCUMENTS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return make


def odd_rows():
    copies = [(200 + i, prose(9, 120), "en", "a", 1) for i in range(4)]
    leaks = [(300 + i, prose(400 + i, 30) + " " + ITEM, "en", "b", 1) for i in range(3)]
    return [*EDGE, *copies, *leaks, *[(500 + i, prose(600 + i, 60), "de", "c", 1) for i in range(30)]]


def test_odd_rows_and_every_stage(spark, folder):
    root = folder(odd_rows(), [(200, 1, 0), (6, 0, 0), (8, 0, 0), (500, 1, 0), (None, 1, 0), (501, None, 0)], [(1, ITEM), (2, None), (None, "x y z")])
    docs = spark.read.parquet(f"{root}/documents.parquet")
    kept = [sorted(r["doc_id"] or -1 for r in docs.collect())]
    for name, function in P.STAGES:
        before, docs = docs, P.stage(function(spark, docs, root), "test")
        rows = docs.collect()
        assert docs.columns[: len(DOC_COLUMNS)] == DOC_COLUMNS
        kept.append(sorted(r["doc_id"] or -1 for r in rows))
        if name == "quality classifier":
            scored = quality.score(before, quality.fit(before, spark.read.parquet(f"{root}/labels.parquet"))).collect()
            assert kept[-1] == sorted(r["doc_id"] or -1 for r in scored if r["score"] >= 0.3)
        if name == "simhash near-dedup":
            groups = {r["component_id"] for r in simhash.linked(before).collect()}
            assert set(kept[-1]) == {-1 if g is None else g for g in groups} and len(rows) == len(groups)
            assert not {201, 202, 203} & set(kept[-1])
        if name == "benchmark decontamination":
            hit = {r["doc_id"] for r in decontam.matches(before, spark.read.parquet(f"{root}/benchmark.parquet")).collect()}
            assert set(kept[-2]) - set(kept[-1]) == hit and (hit == set(kept[-2]) & {300, 301, 302})
        assert set(kept[-1]) <= set(kept[-2])
    assert all(r["shard"] for r in rows)
    run = sorted(r["doc_id"] or -1 for r in P.run(spark, root).collect())
    assert run == kept[-1] and len(run) > 10


def test_without_rows_labels_or_items(spark, folder):
    root = folder([])
    out = P.run(spark, root)
    assert out.count() == 0 and out.columns == [*DOC_COLUMNS, "slot", "shard_no", "shard"]


def test_without_labels_and_items_nothing_is_rejected_for_them(spark, folder):
    root = folder(odd_rows())
    first = P.STAGES[0][1](spark, spark.read.parquet(f"{root}/documents.parquet"), root)
    assert first.count() == len(odd_rows())
    assert P.STAGES[2][1](spark, first, root).count() == len(odd_rows())
