from __future__ import annotations

import numpy as np
import pytest

from tests.llm.helpers import SCHEMA, corpus, words
from weft.llm import pathjoin
from weft.llm.shared import components


def brute(rows):
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := words(t)) and i is not None else frozenset() for i, t in rows]
    label, degree = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 5 * both >= 4 * (len(x) + len(sets[j]) - both):
                degree[i] += 1
                degree[j] += 1
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted((i, least[root(k)] if i is not None else None, degree[k]) for k, (i, _) in enumerate(rows) if i is not None)


@pytest.mark.parametrize("limit", [400, 3])
def test_classes_and_links(spark, limit, monkeypatch):
    if limit == 3:
        monkeypatch.setattr(pathjoin, "BLOCK", 2)
    rows = corpus(3) + [(900, "x y z"), (901, "X, y z!"), (900, "x y z")]
    docs = spark.createDataFrame([(i, t, "q") for i, t in rows], SCHEMA + ", node string")
    got = pathjoin.near_duplicates(docs, limit=limit).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got if r.doc_id is not None) == brute(rows)
    assert [(r.class_id, r.n_links) for r in got if r.doc_id is None] == [(None, 0)]


def test_one_of_each(spark):
    rows = corpus(3) + [(5, corpus(3)[5][1])]
    docs = spark.createDataFrame([(i, t, "q") for i, t in rows], SCHEMA + ", class_id string")
    got = pathjoin.one_of_each(docs).collect()
    expected = {i for i, c, _ in brute(rows) if i == c}
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(expected)
    assert sum(r.doc_id is None for r in got) == 1 and got[0].asDict().keys() == {"doc_id", "text", "class_id"}


def test_empty_table(spark):
    assert pathjoin.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_survival_matches_simulation():
    rng, met, runs = np.random.default_rng(2), 0, 400
    for k in range(runs):
        a = rng.integers(0, 1 << 30, pathjoin.WIDTH).astype(np.uint32)
        b = np.where(rng.random(pathjoin.WIDTH) < 0.8, a, a + 1)
        path, row = np.full(2, pathjoin.tb.mix(np.array([k], np.uint64))[0]), np.arange(2)
        for _ in range(3):
            path, row = pathjoin._descend(path, row, np.stack([a, b]))
        met += bool(set(path[row == 0]) & set(path[row == 1]))
    assert abs(met / runs - pathjoin._survival(0.8, 3)) < 0.09
    assert pathjoin.runs_for(0.9999, 0.8, 6) > pathjoin.runs_for(0.99, 0.8, 6)


def test_components_of_a_chain(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(1, 2), (2, 3), (7, 7), (None, 4)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 100 for k in range(100, 161)} | {1: 1, 2: 1, 3: 1, 7: 7}


def test_components_of_random_graphs(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (330, 2))] + [(1000, k) for k in range(1001, 1100)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == label


def test_texts_that_share_an_id(spark):
    texts = [" ".join(f"{c}{k}" for k in range(40)) for c in "pqrs"]
    near = [t + " end" for t in texts]
    rows = [(1, t) for t in texts] + [(2 + k, t) for k, t in enumerate(near)] + [(1, "other words by themselves only"), (9, "b a"), (9, "B, a!")]
    got = pathjoin.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == brute(rows)
    kept = sorted(map(tuple, pathjoin.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert kept[:5] == sorted([(1, t) for t in texts] + [(1, "other words by themselves only")])
    assert len(kept) == 6 and kept[5][0] == 9


def test_string_ids_and_clashing_columns(spark):
    rows = [(f"d{i}", t) for i, t in corpus(3) if i is not None]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id string, text string, version long, _version long")
    got = pathjoin.near_duplicates(docs)
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got.collect()) == brute(rows)
    kept = pathjoin.one_of_each(docs)
    assert kept.columns == docs.columns and {(r.version, r["_version"]) for r in kept.collect()} == {(1, 2)}


def test_recall_counts_the_shared_embedding():
    runs = pathjoin.runs_for(0.9999, 0.8, 6)
    assert pathjoin.expected_recall(runs, 0.8, 6) >= 0.9999 > pathjoin.expected_recall(runs - 1, 0.8, 6)
    with pytest.raises(ValueError):
        pathjoin.runs_for(0.9999999, 0.8, 6)
