import pytest

import corpus_pipeline
from provlake.llm import bpe, queries, secrets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF).cache()
        assert after.columns == docs.columns and {r.doc_id for r in after.collect()} <= {r.doc_id for r in docs.collect()}
        out.append(after)
        docs = after
    return out


def test_stages_keep_the_columns_and_shrink(kept):
    sizes = [k.count() for k in kept]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 50
    assert kept[-1].select("doc_id").distinct().count() == sizes[-1]
    assert kept[1].where("n_chars <> length(text)").count() == 0


def test_run_encodes_what_is_left(spark, kept):
    a = bpe.automaton(secrets.vocabulary_path("word_bpe_49k.json"))
    want = {r.doc_id: a.encode(r.text)[0] for r in kept[-1].collect()}
    got = {r.doc_id: " ".join(map(str, r.ids)) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_no_copies_and_no_benchmark_left(spark, kept):
    assert kept[2].select("text").distinct().count() == kept[2].count()
    assert queries.decontamination.contamination(kept[3], spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").count() == 0


def test_every_operator_has_one_query():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
