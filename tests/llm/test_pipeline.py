from __future__ import annotations

from types import SimpleNamespace

import pytest

from tests.conftest import DATA
from weft.llm import queries
from weft.llm.shared import drop_stored, maybe_in, shared_dir, stored


def test_maybe_in_loses_nothing(spark):
    df, keys = spark.range(5000).withColumnRenamed("id", "k"), spark.range(0, 5000, 7).withColumnRenamed("id", "k")
    got = {r.k for r in maybe_in(df, keys, "k", bits=10).collect()}
    assert set(range(0, 5000, 7)) <= got
    few = maybe_in(df, keys.filter("k < 70"), "k").count()
    assert 10 <= few < 40


def test_stored_table_is_read_back(spark):
    kept = stored(spark.range(4), "x")
    assert kept.count() == 4
    drop_stored(spark, kept)


def test_pipeline(spark):
    import corpus_pipeline

    sf = str(DATA / "sf0.001")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights"]
    out, columns = docs, docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        new = stored(stage(spark, out, sf), f"t{k}")
        assert new.columns == columns + ["rate"] * (k == 4), name
        assert 0 < new.count() <= out.count()
        out = new
    assert 0.5 * docs.count() < out.count() < docs.count()
    again = corpus_pipeline.run(spark, sf)
    assert sorted((r.doc_id, r.text) for r in again.collect()) == sorted((r.doc_id, r.text) for r in out.collect())


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host"])
def test_clusters_need_a_shared_folder(master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    spark = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(spark)
