from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.llm.helpers import SCHEMA, corpus, words
from weft.llm import chat, licenses, mixing, topk


def test_license_scan(spark):
    templates = {k: licenses.TEMPLATES[k] for k in ("MIT-line", "Apache-2.0", "MIT", "CC-BY-4.0-line")} | {"tiny": "Own terms"}
    full = licenses.TEMPLATES["Apache-2.0"]
    gap = full.replace("limitations", "x").replace("software distributed", "software gladly distributed")
    rows = corpus(8)[:20] + [
        (100, "Text.\nReleased under the MIT License."), (101, "x " * 700 + full.upper()), (102, gap), (103, full[: len(full) // 2]), (104, None), (105, ""), (106, "own terms"),
        (107, licenses.TEMPLATES["MIT"] + "\n" + licenses.TEMPLATES["MIT"]), (100, "Text.\nReleased under the MIT License."), (None, "released under the mit license"),
    ]
    docs = spark.createDataFrame([(i, t, "t") for i, t in rows], SCHEMA + ", template string")
    got = {(r.doc_id, r.template): r for r in licenses.scan(docs, templates).collect()}
    expected = {}
    for i, text in set(rows):
        w = words(text)
        for name, length, size, found in licenses.template_rows(templates):
            best = (0.0, 0)
            for start in range(0, max(1, len(w)), length):
                # a window holds the shingles that begin in it
                held = {" ".join(w[k : k + size]) for k in range(start, min(start + 2 * length, len(w) - size + 1))}
                share = len(held & set(found)) / len(found)
                if share > best[0]:
                    best = (share, start)
            if best[0] >= 0.8:
                expected[i, name] = best
    assert set(got) == set(expected)
    assert all(got[k].containment == pytest.approx(v[0], abs=1e-6) and got[k].window == v[1] for k, v in expected.items())
    assert {(100, "MIT-line"), (101, "Apache-2.0"), (102, "Apache-2.0"), (106, "tiny"), (None, "MIT-line")} <= set(got) and (103, "Apache-2.0") not in got
    assert licenses.scan(docs.limit(0), templates).collect() == [] and licenses.scan(docs, {}).collect() == []


def test_bands_hold_for_the_fullest_window():
    for templates in (licenses.TEMPLATES, {"one": "a b c d e f g h i j k l"}, {"x": "own", "y": "terms"}):
        rows = licenses.template_rows(templates)
        bands = licenses.bands_for(rows, 0.8)
        for name, length, size, found in rows:
            others = {s for n, m, k, x in rows if (m, k) == (length, size) for s in x}
            shared = math.ceil(0.8 * len(found))
            window = min(2 * length, len(others))
            assert (1 - shared / (window + len(found) - shared)) ** bands <= licenses.MISS * 1.0001, name
    assert 20 < licenses.bands_for(licenses.template_rows(licenses.TEMPLATES), 0.8) < 300


def test_license_scan_reports_reserved_rights(spark):
    rows = [(1, "Text.\nAll rights reserved."), (2, "ALL RIGHTS RESERVED"), (3, "All rights are reserved."), (4, licenses.TEMPLATES["reserved"])]
    got = {(r.doc_id, r.template) for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, "reserved-line"), (2, "reserved-line"), (4, "reserved-line"), (4, "reserved")}
    docs = spark.read.parquet(str(DATA / "sf0.01" / "documents.parquet"))
    expected = {r.doc_id for r in docs.filter("text rlike '(?i)\\\\ball[^a-z0-9]+rights[^a-z0-9]+reserved\\\\b'").collect()}
    assert expected and {r.doc_id for r in licenses.scan(docs).filter("template = 'reserved-line'").collect()} == expected


TARGETS = {"en": 0.5, "de": 0.3, "xx": 0.2}


def split_words(text):
    return [w for w in re.split(r"[\s0-9!-/:-@\[-`{-~]+", (text or "").lower()) if w]


def brute_mixture(rows, labelled, targets):
    """Posteriors and rates, document by document."""
    domains, n_buckets = list(targets), mixing.BUCKETS
    bucket = lambda w: xxhash.xxh64_intdigest(w.encode(), 42) % n_buckets
    apart = lambda i: (xxhash.xxh64_intdigest(str(i).encode(), 42) ^ (1 << 63)) - (1 << 63)
    known = sorted({(i, d) for i, _, d in rows if i in labelled and d in targets})
    taught = [(t, d, apart(i) % 5 == 0) for i, d in known for j, t, _ in rows if j == i]
    counts = np.ones((len(domains), n_buckets))
    for text, d, out in taught:
        for w in split_words(text) if not out else ():
            counts[domains.index(d), bucket(w)] += 1
    logs = np.log(counts / counts.sum(1, keepdims=True))
    weights = logs - logs.mean(0)
    prior = np.log([sum(d == x for _, d, _ in taught) / len(taught) for x in domains])

    def posterior(text, scale, power):
        b = [bucket(w) for w in split_words(text)]
        z = weights[:, b].sum(1) * scale * max(len(b), 1) ** -power + prior
        e = np.exp(z - z.max())
        return e / e.sum()

    losses = {}
    for power in (0.0, 0.25, 0.5, 0.75):
        for j in range(-14, 7):
            losses[round(np.mean([-np.log(posterior(t, 2 ** (j / 2), power)[domains.index(d)]) for t, d, out in taught if out]), 9), power, 2 ** (j / 2)] = 1
    _, power, scale = min(losses)
    p, n = np.array([posterior(t, scale, power) for _, t, _ in rows]), np.array([len((t or "").split()) for _, t, _ in rows], float)
    r, base = np.ones(len(n)), n @ p
    goal = n.sum() * np.array(list(targets.values()))
    for _ in range(300):
        r = np.maximum(r - p @ ((((r * n) @ p) - goal) / base), 0)
    return p, r


def languages(n=120):
    rng, letters = random.Random(1), {"en": "thewoaist", "de": "einrdschü", "xx": "zqxkjñáé"}
    rows = []
    for k in range(n):
        lang = rng.choice(["en", "en", "en", "de", "xx"])
        rows.append((k, " ".join("".join(rng.choices(letters[lang], k=4)) for _ in range(rng.randint(3, 40))), lang))
    return rows + [(900, None, "en"), (901, "", "de"), (902, "   ", None), (None, "thew", "en"), (3, "double", "en")]


def test_mixture_meets_targets(spark):
    docs = spark.createDataFrame(languages(), SCHEMA + ", lang string").withColumn("rate", F.lit("r"))
    labels = spark.createDataFrame([(k, 1) for k in range(0, 120, 2)] + [(None, 1), (5, None)], "doc_id long, quality int")
    rows, model = mixing.mixture(docs, labels, TARGETS)
    got = rows.collect()
    assert len(got) == docs.count() and model.names == ["en", "de", "xx"]
    p, n, rate = np.array([r.p for r in got]), np.array([r.n_tokens for r in got], float), np.array([r.rate for r in got])
    assert (rate >= 0).all() and np.allclose(p.sum(1), 1)
    total = (rate * n) @ p
    assert np.allclose(total / total.sum(), [TARGETS[d] for d in model.names], atol=1e-5) and total.sum() == pytest.approx(n.sum(), rel=1e-5)
    assert model.converged and np.allclose(model.residual, 0, atol=1e-5)
    given = docs.select("doc_id", "text").collect()
    expected_p, expected_rate = brute_mixture(languages(), set(range(0, 120, 2)), TARGETS)
    key = lambda i, t: (i is None, i or 0, t)
    order = sorted(range(len(got)), key=lambda k: key(got[k].doc_id, got[k].n_tokens))
    same = sorted(range(len(given)), key=lambda k: key(given[k].doc_id, len((given[k].text or "").split())))
    assert [got[k].n_tokens for k in order] == [len((given[k].text or "").split()) for k in same]
    assert np.allclose(p[order], expected_p[same], atol=1e-6) and np.allclose(rate[order], expected_rate[same], atol=1e-5)
    assert {r.n_tokens for r in got if r.doc_id in (900, 901, 902)} == {0}
    kept = mixing.mixed(docs, labels, TARGETS)
    assert kept.columns == ["doc_id", "text", "lang", "rate"] and kept.count() == sum(rate > 0)
    out = dict(zip([r.doc_id for r in got if r.doc_id not in (None, 3)], [x for r, x in zip(got, rate, strict=True) if r.doc_id not in (None, 3)], strict=True))
    assert all(r.rate == pytest.approx(out[r.doc_id]) for r in kept.collect() if r.doc_id in out)


def test_words_are_cut_at_digits_and_punctuation(spark):
    texts = ["One, two  THREE4four\n(été) it's", "  ", "", None, "...", "a"]
    got = {r.doc_id: r.b for r in spark.createDataFrame(list(enumerate(texts)), SCHEMA).select("doc_id", mixing.word_buckets(F.col("text")).alias("b")).collect()}
    assert got == {k: [xxhash.xxh64_intdigest(w.encode(), 42) % mixing.BUCKETS for w in split_words(t)] for k, t in enumerate(texts)}
    assert len(got[0]) == 7


def test_clashing_columns_of_a_mixture(spark):
    names = ["_p", "_top", "_n", "_buckets", "_logit0", "rate", "N"]
    docs = spark.createDataFrame([(*r, *range(7)) for r in languages()], SCHEMA + ", lang string, " + ", ".join(f"`{n}` int" for n in names))
    labels = spark.createDataFrame([(k, 1) for k in range(60)], "doc_id long, quality int")
    kept = mixing.mixed(docs, labels, TARGETS)
    assert kept.columns == ["doc_id", "text", "lang", *(n for n in names if n != "rate"), "rate"]
    assert {tuple(r[n] for n in names if n != "rate") for r in kept.collect()} == {(0, 1, 2, 3, 4, 6)}


def test_targets_out_of_reach(spark):
    docs = spark.createDataFrame([(k, "one two three" if k % 2 else "uno due tre", "ab"[k % 2]) for k in range(40)], SCHEMA + ", lang string")
    labels = spark.createDataFrame([(k, 1) for k in range(40)], "doc_id long, quality int")
    _, model = mixing.mixture(docs, labels, {"a": 0.5, "b": 0.3, "none": 0.2})
    assert model.names == ["a", "b"] and model.converged and np.allclose(model.residual, 0, atol=1e-5)
    soft = spark.createDataFrame([(10, [0.6, 0.4]), (10, [0.5, 0.5])], "n_tokens long, p array<double>")
    model = mixing.fit_rates(soft, mixing.Domains(["a", "b"], [0.5, 0.5], []), {"a": 0.1, "b": 0.9}, max_steps=1000)
    assert model.converged and max(map(abs, model.residual)) > 0.1


def test_mixture_without_labels_or_rows(spark):
    docs = spark.createDataFrame(languages(), SCHEMA + ", lang string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows, _ = mixing.mixture(docs, none, TARGETS)
    assert all(np.allclose(r.p, 1 / 3) for r in rows.collect())
    assert mixing.mixture(docs.limit(0), none, TARGETS)[0].collect() == []


def test_rates_reach_zero(spark):
    soft = spark.createDataFrame([(10, [1.0, 0.0]), (10, [0.5, 0.5]), (10, [0.0, 1.0])], "n_tokens long, p array<double>")
    model = mixing.fit_rates(soft, mixing.Domains(["a", "b"], [0.5, 0.5], []), {"a": 1.0, "b": 0.0}, max_steps=200)
    rates = [r[0] for r in soft.select(model.rate("p")).collect()]
    assert min(rates) == 0 and rates[0] > 1


def test_top_scores(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.normal(size=8)]) for k in range(150)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (300, None), (301, []), (302, [1.0, None] + [0.0] * 6), (303, [math.nan] * 8), (304, [math.inf] * 8), (None, rows[0][1]), (7, rows[7][1]), (306, [0.5, 0.5]), (320, [1.0, -1.0]), (340, []), (341, []), (360, [900.0] * 3), (361, [2.0] * 3)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = topk.top_scores(df, F.col("vec_id") % 20 == 0, k=5, sample_rows=40, query_block=3, row_block=16).collect()
    ok = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    expected = []
    for i, v in ok:
        if i % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in ok if j != i and len(w) == len(v))[:5]
            expected += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(expected)
    assert topk.top_scores(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_pivot_bounds_skip_far_candidates():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(400, 4)) * 3) + np.repeat(np.arange(4), 100)[:, None] * 100
    ids = np.arange(400)
    table = topk._distances(x, topk.choose_pivots(x, 8)).astype(np.float32)
    q, v, s = topk.search(ids[:5], x[:5], table[:5], np.full(5, -np.inf), ids, x, table, 3, step=32)
    for k in range(5):
        score = x @ x[k]
        score[k] = -np.inf
        assert sorted(s[q == k]) == sorted(np.sort(score)[-3:])


def test_rotation(spark):
    rows = [
        (1, 0, "user", "Hi <|end|>"), (1, 1, "assistant", "Hello"), (1, 2, "user", None), (1, 2, "user", None), (1, 1, "Bob", "Yes"), (2, None, " ", "alone"),
        (None, 0, "user", "lost"), (3, 0, "a", "x"), (3, 70, "b", "y"), (3, -1, "a", "before"),
    ]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, part string")
    got = {(r.conv_id, r.assistant, r.part): r for r in chat.rotated(df).collect()}
    bob = got[1, "Bob", 0]
    assert bob.text == "<|user|>user\nHi < |end|><|end|>\n<|assistant|>\nYes<|end|>\n<|user|>assistant\nHello<|end|>\n<|user|>user\n<|end|>\n"
    assert [bob.text[m["first"] : m["last"]] for m in bob.mask] == ["Yes<|end|>\n"] and (bob.n_turns, bob.n_assistant_turns) == (4, 1)
    assert [got[1, "user", 0].text[m["first"] : m["last"]] for m in got[1, "user", 0].mask] == ["Hi < |end|><|end|>\n", "<|end|>\n"]
    assert got[2, "unknown", -1].text == "<|assistant|>\nalone<|end|>\n"
    assert {k[2] for k in got if k[0] == 3} == {-1, 0, 1} and len(got) == 3 + 1 + 6
    assert chat.rotated(df.limit(0)).collect() == []
