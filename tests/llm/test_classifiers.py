from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SCHEMA
from weft.llm import quality, toxicity
from weft.llm import textbytes as tb
from weft.llm.boosting import BoostedTrees, Isotonic


def labelled(kind, n=500):
    rng = random.Random(kind)
    vocabulary = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 6))) for _ in range(200)]
    rows, labels = [], []
    for k in range(n):
        w = rng.choices(vocabulary, k=rng.randint(5, 60))
        bad = rng.random() < 0.3
        if kind == "toxic" and bad:
            for _ in range(3):
                w.insert(rng.randint(0, len(w)), rng.choice(["idiot", "veq" + rng.choice(vocabulary), "you moron"]))
        if kind == "quality" and not bad:
            w = [x.upper() + "!!" for x in w] if rng.random() < 0.5 else [w[0]] * len(w)
        rows.append((k, " ".join(w)))
        labels.append((k, int(bad)))
    return rows, labels


ODD = [(9000, None), (9001, ""), (9002, "  \n"), (9003, "!!!"), (None, "some words"), (3, "repeated id"), (9004, "x" * 400_000)]


@pytest.mark.parametrize(("kind", "run", "modulus", "held", "limit"), [("toxic", toxicity.toxicity_scores, 4, 2, 0.3), ("quality", quality.quality_scores, 3, 1, 0.5)])
def test_held_out_accuracy(spark, kind, run, modulus, held, limit):
    rows, labels = labelled(kind)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows + ODD], SCHEMA + ", score int")
    table = spark.createDataFrame(labels + [(9999, 1), (None, 1), (1, None)], f"doc_id long, {kind} int")
    got = run(docs, table).collect()
    assert len(got) == len(rows) + len(ODD)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= limit) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held) for r in got if r.doc_id is not None)
    truth = dict(labels)
    test = [r for r in got if r.held_out and r.doc_id in truth and r.doc_id != 3]
    assert np.mean([r.predicted == truth[r.doc_id] for r in test]) > 0.9
    assert run(docs.limit(0), table).collect() == []
    assert {r.score for r in run(docs, table.limit(0)).collect()} == {0.5}


def test_learns_from_no_held_out_label(spark):
    rows, labels = labelled("toxic", 300)
    docs = spark.createDataFrame(rows, SCHEMA)
    flip = [(i, y if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - y) for i, y in labels]
    one, two = ({r.doc_id: r.score for r in toxicity.toxicity_scores(docs, spark.createDataFrame(x, "doc_id long, toxic int")).collect()} for x in (labels, flip))
    assert one == two


def test_toxic_documents_go(spark):
    rows, labels = labelled("toxic")
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows + ODD], SCHEMA + ", y string")
    got = toxicity.remove_toxic(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert got.columns == docs.columns
    left = {r.doc_id for r in got.collect()}
    clean, bad = [i for i, y in labels if not y], [i for i, y in labels if y]
    assert np.mean([i in left for i in clean]) > 0.97 and np.mean([i in left for i in bad]) < 0.15
    assert {9000, 9001, 9002} <= left


def brute_features(text, weights):
    raw = (text or "").encode()
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in raw)
    is_word = lambda c: 48 <= c <= 57 or 97 <= c <= 122 or c >= 128

    def runs(data, inside):
        out, at = [], None
        for k in range(len(data) + 1):
            on = k < len(data) and inside(data[k])
            if on and at is None:
                at = k
            if not on and at is not None:
                out.append((at, k))
                at = None
        return out

    spans = runs(low, is_word)
    w = [low[a:b].decode("utf-8", "replace") for a, b in spans]
    n, size = max(len(w), 1), max(len(raw), 1)
    bad, you = [k for k, x in enumerate(w) if x in toxicity.INSULTS], [k for k, x in enumerate(w) if x in toxicity.SECOND_PERSON]
    plain = bytes(ord(toxicity.LOOKALIKES.get(chr(c), chr(c))) if c < 128 else c for c in low)
    hidden = sum(plain[a:b].decode("utf-8", "replace") in toxicity.INSULTS for a, b in runs(plain, lambda c: 97 <= c <= 122 or c >= 128))
    letter = lambda c: 97 <= c <= 122
    mixed = sum(any(48 <= c <= 57 for c in low[a:b]) and any(map(letter, low[a:b])) for a, b in spans)
    starred = sum(raw[k] in b"*#$@" and letter(low[k - 1]) and letter(low[k + 1]) for k in range(1, len(raw) - 1))
    shout = sum(b - a > 1 and all(65 <= c <= 90 for c in raw[a:b]) for a, b in spans)
    repeats = sum(raw[k] == raw[k - 1] == raw[k - 2] != 32 for k in range(2, len(raw)))
    known = [max([0.0] + [weights.get(low[a:b], 0)] + [weights.get((low[a : a + m], m), 0) for m in (4, 5, 6) if b - a > m]) for a, b in spans]
    strong = sum(x >= 3 for x in known)
    return [
        min(len(bad), 20), len(bad) / n, len({w[k] for k in bad}), sum(any(abs(k - j) <= 5 for j in you) for k in bad), len(you) / n, max(hidden - len(bad), 0), mixed / n, starred / n,
        sum(65 <= c <= 90 for c in raw) / size, shout / n, raw.count(b"!") / size, raw.count(b"?") / size, sum(32 < c < 128 and not is_word(c) and not 65 <= c <= 90 for c in raw) / size,
        repeats / size, sum(48 <= c <= 57 for c in raw) / size, sum(b - a for a, b in spans) / n, np.log1p(len(w)), min(strong, 20), strong / n, sum(known) / n, max(known, default=0),
    ]


def test_features_of_toxicity():
    rng = random.Random(4)
    pieces = ["you", "YOU", "idiot", "Moron", "1d10t", "m*ron", "st*pid", "scheiße", "sh1t", "abcd3", "vexing", "vexi", "garden", "!!!", "??", "aaa", "  ", "*b", "a*", "$", "é", "ABC", "X", "w0rd", "\n", "du", "#", "7"]
    texts = ["".join(rng.choice(pieces) + rng.choice([" ", "", ", "]) for _ in range(rng.randint(0, 40))) for _ in range(120)] + ["", "a", "*", "aa", "a*b", "you " * 30 + "idiot " * 30, "aaa"]
    known = tb.words_of(*tb.column_bytes(pa.array(["vexing garden"])))
    keys = {b"garden": known.hash[1], (b"vexi", 4): known.ranges(known.start[:1], known.start[:1] + 4, 4)[0], b"vexing": known.hash[0]}
    weights = {b"garden": 2.0, (b"vexi", 4): 3.5, b"vexing": 4.0}
    lexicon = toxicity.Lexicon(np.array([keys[k] for k in weights], np.uint64), np.array(list(weights.values())))
    got = toxicity.features(*tb.column_bytes(pa.array(texts)), lexicon)
    assert got.shape == (len(texts), len(toxicity.FEATURES))
    for k, text in enumerate(texts):
        expected = brute_features(text, weights)
        for name, x, y in zip(toxicity.FEATURES, got[k], expected, strict=True):
            assert x == pytest.approx(y), (name, text)
        assert np.allclose(toxicity.features(*tb.column_bytes(pa.array([text])), lexicon)[0], got[k])


def test_vectors_of_words():
    """Word vectors and pooled features against sums taken token by token."""
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["the", "of", "Foo,", "bar7", "bar7 bar7", "Élan", "x-y"]) for _ in range(rng.randint(0, 30))) for _ in range(25)] + ["", "  ", "one"]
    data, offsets = tb.column_bytes(pa.array(texts))
    frequent = np.unique(tb.RangeHash(np.frombuffer(b"the", np.uint8))(np.array([0]), np.array([3])))
    places, signs = quality.index_vectors()
    table = np.zeros(quality.ROWS * quality.DIM)
    quality.add_contexts(table, data, offsets, places, signs, frequent)
    word, shape, bounds = quality.tokens(data, offsets, frequent)
    expected = np.zeros((quality.ROWS, quality.DIM))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        for i in range(a, b):
            for j in range(max(a, i - 2), min(b, i + 3)):
                for entry in (word, shape):
                    if i != j:
                        for place, sign in zip(places[entry[j]], signs[entry[j]], strict=True):
                            expected[entry[i], place] += sign
    assert np.allclose(table.reshape(expected.shape), expected)
    assert [len(t.split()) for t in texts] == np.diff(bounds).tolist()
    own = [w == "the" for t in texts for w in t.split()]
    assert [x == 0 for x in word] == own and (word < quality.OWN + quality.WORDS).all() and (shape >= quality.OWN + quality.WORDS).all()
    vectors = np.random.default_rng(1).normal(size=(quality.ROWS, quality.DIM)).astype(np.float32)
    got = quality.pooled(data, offsets, vectors, frequent)
    for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if a < b:
            parts = [f(vectors[entry[a:b]].astype(float)) for entry in (word, shape) for f in (lambda x: x.mean(0), lambda x: x.std(0))]
            assert np.allclose(got[k], [*np.concatenate(parts), np.log1p(b - a)], atol=1e-3)
        else:
            assert not got[k].any()


def test_frequent_words(spark, monkeypatch):
    texts = ["a b c d"] * 8 + ["a b c"] * 8 + ["a b"] * 40 + [None, "", "a " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(3)
    hashed = {w: int(tb.RangeHash(np.frombuffer(w.encode(), np.uint8))(np.array([0]), np.array([1]))[0]) for w in "abcd"}
    names = lambda **options: {w for w, h in hashed.items() if h in quality.frequent_words(docs, **options).tolist()}
    assert names() == {"a", "b", "c"} and names(least_count=1) == set("abcd") and names(most=2) == {"a", "b"} and names(most=1) == {"a"}
    assert len(quality.frequent_words(docs.limit(0))) == 0


def test_a_hot_id_stays_within_the_bound(spark):
    rows = [(1, f"text {k % 50}") for k in range(3000)] + [(2, "other words"), (2, "other words")]
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (2, 0)], "doc_id long, toxic int")
    got = toxicity.labelled_sample(spark.createDataFrame(rows, SCHEMA), labels, "toxic", F.lit(False), 40)
    assert got.count() == 40
    every = toxicity.labelled_sample(spark.createDataFrame(rows, SCHEMA), labels, "toxic", F.lit(False), 1000).collect()
    assert len(every) == 101 and sum(r.text == "other words" for r in every) == 1


def test_isotonic_is_monotone():
    rng = np.random.default_rng(1)
    score = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-2 * score))).astype(float)
    fitted = Isotonic().fit(score, y)(np.linspace(-3, 3, 50))
    assert (np.diff(fitted) >= 0).all() and 0 <= fitted.min() and fitted.max() <= 1


def test_trees_fit_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    assert ((BoostedTrees().fit(x[:1500], y[:1500]).raw(x[1500:]) > 0) == y[1500:]).mean() > 0.95
