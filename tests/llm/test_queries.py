"""The registered corpus queries: against their SQL where there is one, else for their columns and row counts."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry
import corpus_pipeline
from starmart.llm import decontam, queries, quality, simhash
from starmart.llm.common import DOC_COLUMNS, read

SF = "/root/testdata/sf0.001"
COLUMNS = {
    1: {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    3: {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    4: {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    5: {"doc_id", "fingerprint", "component_id"},
    6: {"doc_id", "held_out", "score", "predicted"},
    8: {"doc_id", "held_out", "lang_pred", "score"},
    9: {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    11: {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
    12: {"doc_id", "n_shingles", "component_id", "kept"},
    13: {"lang", "rank", "phrase", "a", "l", "r", "n", "score"},
}


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n != "pipeline"])
def test_query(spark, name):
    problem, n, _ = compare(spark, duck(SF), SF, queries.QUERIES[name], queries.ORACLES.get(name))
    assert problem is None
    number = int(name[2:].split("_")[0])
    table = {4: "pages", 11: "embeddings"}.get(number, "documents")
    assert number in (7, 13) or n == read(spark, SF, table).count() * (32 if number == 11 else 1)
    if number in COLUMNS:
        assert COLUMNS[number] <= set(queries.QUERIES[name](spark, SF).columns)


def test_pipeline_stages(spark):
    docs = read(spark, SF, "documents")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stage(stage(spark, docs, SF))
        sizes.append(docs.count())
        assert docs.columns[: len(DOC_COLUMNS)] == DOC_COLUMNS
        if name == "quality classifier":
            model = quality.fit(before, read(spark, SF, "labels"))
            assert docs.exceptAll(before).count() == 0
            assert sizes[-1] == quality.score(before, model).filter("score >= 0.3").count()
        if name == "simhash near-dedup":
            groups = simhash.linked(before).toPandas()
            assert {r["doc_id"] for r in docs.collect()} == set(groups.component_id)
        if name == "benchmark decontamination":
            hit = decontam.matches(before, read(spark, SF, "benchmark")).toPandas()
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in before.collect()} - set(hit.doc_id)
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0 and docs.columns[-1] == "shard"
