"""Every query of the training-data operators against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from tests.conftest import DATA
from weft.llm import queries

SF = DATA / "sf0.001"
TABLES = "documents embeddings benchmark labels conversations".split()


@pytest.mark.skipif(not SF.exists(), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    import duckdb

    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, str(SF))
    columns = sorted(df.columns)
    found = duck.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    plain = lambda rows: sorted(tuple(map(str, r)) for r in rows)
    assert plain([[r[c] for c in columns] for r in df.collect()]) == plain([[r[names.index(c)] for c in columns] for r in found.fetchall()])


def test_operators_leave_the_session_as_it_is(spark):
    from weft.llm import decontaminate, repeats

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.unset(name)
    own = spark.conf.get(name)
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    repeats.without_repeats(docs).collect()
    decontaminate.contamination_report(docs, docs.withColumnRenamed("doc_id", "item_id")).collect()
    assert spark.conf.get(name) == own
    spark.conf.set(name, before)
