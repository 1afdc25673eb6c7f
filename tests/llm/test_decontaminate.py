from __future__ import annotations

import hashlib
import random

import pytest

from tests.llm.helpers import SCHEMA, corpus, words
from weft.llm import decontaminate


def items_from(rows, short):
    long = " ".join(words(rows[0][1]) + words(rows[1][1]))
    return [(1, "Intro! " + long[:400]), (2, rows[2][1]), (3, long), (30, "zzz"), (4, None), (5, "..."), (None, rows[4][1]), (2, rows[2][1])] + ([(6, " ".join(words(rows[3][1])[:3])), (7, words(rows[3][1])[0])] if short else [])


def brute(rows, items):
    windows = {}
    for name, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(name)
    out = []
    for i, text in rows:
        w, held = words(text), set()
        hit = [0] * len(w)
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    held |= windows[tuple(w[k : k + size])]
                    hit[k : k + size] = [1] * size
        ids = sorted(str(x) for x in held - {None})
        out.append((str(i), len(w), sum(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), any(hit)))
    return sorted(out)


@pytest.mark.parametrize(("short", "shard"), [(False, 200_000), (True, 200_000), (True, 20), (False, 40)])
def test_report(spark, short, shard):
    rows = corpus(6)
    items = items_from(rows, short)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA + ", spans string")
    got = decontaminate.contamination_report(docs, spark.createDataFrame(items, "item_id long, text string"), shard_words=shard).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == brute(rows, items)


def test_spans_are_cut_and_full_documents_go(spark):
    rows = corpus(6)
    passage = " ".join(f"item{k}" for k in range(14))
    filler = " ".join(f"own{k}" for k in range(40))
    docs = spark.createDataFrame(rows + [(700, f"Ünder {filler} {passage.upper()} tail"), (701, passage), (702, None)], SCHEMA).selectExpr("*", "length(text) n_chars", "'s' spans")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.remove_spans(docs, items).collect()}
    assert got[700].text == f"Ünder {filler}  tail" and got[700].n_chars == len(got[700].text)
    assert 701 not in got and got[702].text is None and got[702].spans == "s"
    assert all(got[i].text == t for i, t in rows if i is not None)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination_report(docs, items).collect() == []
    got = decontaminate.contamination_report(spark.createDataFrame([(1, "a b")], SCHEMA), items).first()
    assert (got.n_words, got.n_hit, got.contaminated) == (2, 0, False)


def test_many_shards(spark):
    """Each shard has a bounded number of words, however long an item is."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefg", k=rng.randint(1, 4)))
    items = [(k, " ".join(word() for _ in range(rng.randint(12, 60)))) for k in range(120)] + [(500, " ".join(word() for _ in range(3000)))]
    rows = []
    for k in range(80):
        text = [word() for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            source = rng.choice(items)[1].split()
            a = rng.randrange(len(source))
            text[rng.randint(0, len(text)) : 0] = source[a : a + rng.randint(5, 40)]
        rows.append((k, " ".join(text)))
    rows += [(900, items[500 - 380][1]), (901, items[3][1]), (901, items[3][1]), (None, items[4][1])]
    given = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], SCHEMA + ", k1 int, _may int")
    got = decontaminate.match_spans(docs, given, shard_words=130)
    assert got.columns == ["doc_id", "text", "k1", "_may", "n_words", "spans", "item_ids"]
    found = decontaminate.contamination_report(docs, given, shard_words=130).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found) == brute(rows, items)
    named = given.selectExpr("cast(item_id as string) name", "text").distinct()
    parts = decontaminate._item_parts(named, 10, 32).selectExpr("pmod(xxhash64(name, words), 50) shard", "size(hashes) n").groupBy("shard").sum("n").collect()
    assert len(parts) > 40 and max(r[1] for r in parts) < 8 * 130
    cut = decontaminate.remove_spans(docs, given, shard_words=130).collect()
    whole = decontaminate.remove_spans(docs, given).collect()
    assert sorted(map(str, cut)) == sorted(map(str, whole))
