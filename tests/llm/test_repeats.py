from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tests.llm.helpers import SCHEMA, corpus
from weft.llm import repeats, suffixes


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(0)
    for trial in range(150):
        n = int(rng.integers(1, 100))
        s = rng.integers(1, rng.integers(2, 7) + 1, n)
        s = np.tile(s[: max(1, n // 7)], 7)[:n] if trial % 3 == 0 else s
        t = np.append(s, 0)
        sa = suffixes.suffix_array(t)
        assert list(sa) == sorted(range(len(t)), key=lambda i: tuple(t[i:]))  # noqa: B023
        shared = suffixes.permuted_lcp(t.astype(np.uint8), sa)
        for a, b in zip(sa[:-1], sa[1:], strict=True):
            k = 0
            while max(a, b) + k < len(t) and t[a + k] == t[b + k]:
                k += 1
            assert shared[b] == k


def test_reduced_strings_of_many_symbols():
    rng = np.random.default_rng(1)
    for width, copies in ((60, 5), (700, 3), (3000, 2)):
        t = np.append(np.tile(rng.integers(1, 5000, width), copies), 0)
        assert list(suffixes.suffix_array(t)) == sorted(range(len(t)), key=lambda i: tuple(t[i:]))  # noqa: B023


def test_both_scans_give_one_array(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [np.append(rng.integers(1, k, 400), 0) for k in (2, 3, 30)] + [np.append(np.repeat(rng.integers(1, 4, 40), rng.integers(1, 60, 40)), 0)]
    found = []
    for cost in (0, 1 << 40):
        monkeypatch.setattr(suffixes, "WAVE_COST", cost)
        found.append([suffixes.suffix_array(t).tolist() for t in texts])
    assert found[0] == found[1] == [sorted(range(len(t)), key=lambda i: tuple(t[i:])) for t in texts]  # noqa: B023


def brute(rows, length):
    order = sorted({(i if i is not None else 1 << 62, t or "", i) for i, t in rows}, key=lambda x: x[0])
    seen, out = set(), {}
    for _, text, i in order:
        raw = text.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(bool(g) and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("options", [{}, {"hot_bytes": 400, "shard_bytes": 500}])
def test_removed_bytes(spark, options):
    rows = corpus(2)
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA + ", n_bytes string, doc long")
    expected = brute(rows, 60)
    got = repeats.without_repeats(docs, 60, gram=16, **options).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id]
        assert sum(s["last"] - s["first"] for s in r.spans) == r.n_removed


@pytest.mark.parametrize("length", [50, 100, 146, 200, 300])
def test_lengths(spark, length):
    rng = random.Random(length)
    passage = "".join(rng.choices("abc d", k=900))
    rows = [(k, "".join(rng.choices("abc d", k=rng.randint(0, 200))) + passage[rng.randint(0, 500) :][: rng.randint(0, 800)] + "".join(rng.choices("ab", k=rng.randint(0, 200)))) for k in range(25)]
    rows += [(50, "x" * 700 + passage), (51, "xy" * 300), (52, "yx" * 200)]
    expected = brute(rows, length)
    for r in repeats.without_repeats(spark.createDataFrame(rows, SCHEMA), length).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id]
    with pytest.raises(ValueError):
        repeats.without_repeats(spark.createDataFrame(rows, SCHEMA), 10)


def test_string_ids(spark):
    rows = [(f"{k}", t) for k, t in corpus(2) if k is not None]
    seen, expected = set(), {}
    for i, text in sorted(set(rows), key=lambda x: x[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 59):
            if raw[p : p + 60] in seen:
                gone[p : p + 60] = b"\1" * 60
            seen.add(raw[p : p + 60])
        expected[i] = sum(gone)
    got = repeats.without_repeats(spark.createDataFrame(rows, "doc_id string, text string"), 60, gram=16).collect()
    assert {r.doc_id: r.n_removed for r in got} == expected


def test_texts_of_one_id_are_ordered(spark):
    text = "".join(random.Random(3).choices("abcd ", k=300))
    docs = spark.createDataFrame([(1, text), (1, text + "tail"), (1, text)], SCHEMA)
    got = repeats.without_repeats(docs).collect()
    assert sorted(r.n_removed for r in got) in ([0, 0, 300], [0, 300, 300])


def test_long_text_is_cut_without_effect():
    data = np.random.default_rng(5).integers(97, 100, 3000).astype(np.uint8)
    whole = repeats.pieces(data, np.array([0, 3000]), 60, 16)
    starts = np.concatenate([np.arange(s, s + c) for s, c in zip(whole[3], whole[4], strict=True)])
    assert list(starts) == list(range(3000 - 59))


def test_empty_table(spark):
    assert repeats.without_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
