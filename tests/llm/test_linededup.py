from __future__ import annotations

import numpy as np

from tests.llm.helpers import SCHEMA, corpus
from weft.llm import linededup


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance():
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 100, rng.integers(1, 12)).astype(np.uint8) for _ in range(60)]
    a, b = map(np.array, zip(*[(i, j) for i in range(60) for j in range(i)], strict=True))
    size = np.array([len(t) for t in texts])
    for most in (1, 2, 3):
        got = linededup.within_distance(np.concatenate(texts).astype(np.int16), np.cumsum(size) - size, size, a, b, most, lanes=100)
        assert list(got) == [edits(texts[i], texts[j]) <= most for i, j in zip(a, b, strict=True)]


def test_line_bounds():
    texts = ["a\n\n b \n", "", "\n", "x"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    row, number, first, last = linededup.lines_of(data, offsets)
    got = [(r, k, data[a:b].tobytes().decode()) for r, k, a, b in zip(row, number, first, last, strict=True)]
    assert got == [(r, k, line.strip()) for r, t in enumerate(texts) for k, line in enumerate(t.split("\n"))]


#: Exact copies from 20 bytes, near ones of two edits from 48.
OLD = {"min_bytes": 20, "classes": [linededup.Near(False, 2, 48)]}
BASE = "the quick brown fox jumps over the lazy dog and runs into the deep dark forest"


def rows():
    more = [
        (500, BASE + "\nshort"), (501, BASE.replace("lazy", "lzy")), (502, BASE.replace("quick", "quack").replace("dark", "darc") + "\n\n"), (503, "  " + BASE + "\t\nshort"),
        (504, "x" + BASE.replace("fox", "fx")), (505, BASE.replace("quick", "qwwwck") + "\nshort line kept"), (501, BASE.replace("lazy", "lzy")),
    ]
    return corpus(4) + more


def brute(rows, most=2, least=20, near=48):
    order = sorted({(i if i is not None else 1 << 62, t or "", i) for i, t in rows}, key=lambda x: x[0])
    first, lines = {}, []
    for _, text, i in order:
        for k, line in enumerate(text.split("\n")):
            line = line.encode().strip(bytes(range(33)))
            lines.append((i, k, line))
            if len(line) >= least:
                first.setdefault(line, len(first))
    long = [x for x in first if len(x) >= near]
    close = {max(x, y, key=first.get) for x in long for y in long if x < y and abs(len(x) - len(y)) <= most and edits(x, y) <= most}
    seen, out = set(), {i: [] for i, _ in rows}
    for i, k, line in lines:
        if len(line) >= least:
            if line in seen or line in close:
                out[i].append(k)
            seen.add(line)
    return out


def test_removed_lines(spark):
    expected = brute(rows())
    docs = spark.createDataFrame([(i, t, 1, "y") for i, t in rows()], SCHEMA + ", line long, lines string")
    got = linededup.line_report(docs, **OLD).collect()
    assert len(got) == len(rows())
    for r in got:
        assert r.removed_lines == ",".join(map(str, expected[r.doc_id])) and r.n_removed == len(expected[r.doc_id])


def test_large_keys_are_compared_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(linededup, "BLOCK", 2)
    expected = brute(rows())
    for r in linededup.line_report(spark.createDataFrame(rows(), SCHEMA), **OLD).collect():
        assert r.removed_lines == ",".join(map(str, expected[r.doc_id]))


def test_texts_without_removed_lines(spark):
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows()], SCHEMA + ", n_chars long")
    expected, texts = brute(rows()), dict(rows())
    got = linededup.without_repeated_lines(docs, **OLD).collect()
    for r in got:
        if r.doc_id is None or texts[r.doc_id] is None:
            continue
        kept = [x for k, x in enumerate(texts[r.doc_id].split("\n")) if k not in expected[r.doc_id]]
        assert r.text == "\n".join(kept) and r.n_chars == len(r.text)
    left = {i for i, gone in expected.items() if i is not None and (not gone or "".join(x for k, x in enumerate(texts[i].split("\n")) if k not in gone).strip())}
    assert {r.doc_id for r in got if r.doc_id is not None} == left
    assert linededup.without_repeated_lines(docs.limit(0)).collect() == []


def test_query_and_stage_remove_copies_of_short_lines(spark, tmp_path):
    import corpus_pipeline
    from weft.llm import queries

    texts = [(1, "Les.\n\nLes.\nOnce\n" + BASE), (2, " Les. \nx\n\nWh the."), (3, "x\nWh the.\nNt onor. The of it."), (4, "Nt onor. The of it.\n" + BASE)]
    spark.createDataFrame(texts, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.removed_lines for r in queries.op2_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: "2", 2: "0", 3: "0,1", 4: "0,1"}
    left = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, spark.createDataFrame(texts, SCHEMA), "").collect()}
    assert left == {1: "Les.\n\nOnce\n" + BASE, 2: "x\n\nWh the.", 3: "Nt onor. The of it."}


def near_by_classes(x, y):
    """Brute force over whole lines: the thresholds are those of the shorter line."""
    least = min(len(x), len(y))
    most = 2 if least >= 20 else 1 if least >= 10 else 0
    if most and abs(len(x) - len(y)) <= most and edits(x, y) <= most:
        return True
    a, b = x.split(), y.split()
    least = min(len(a), len(b))
    most = 4 if least >= 64 else 2 if least >= 32 else 1 if least >= 8 else 0
    return bool(most) and abs(len(a) - len(b)) <= most and edits(a, b) <= most


def test_near_copies_by_growing_thresholds(spark):
    rng = np.random.default_rng(5)
    vocabulary = ["".join(chr(c) for c in rng.integers(97, 123, rng.integers(3, 11))) for _ in range(500)]
    lines = []
    for n in (1, 2, 3, 5, 7, 8, 12, 31, 32, 33, 62, 63, 64, 65, 66, 90, 150):
        for _ in range(3):
            base = list(rng.choice(vocabulary, n))
            lines.append(" ".join(base))
            for changes in (1, 2, 4, 5):
                new = list(base)
                for _ in range(changes):
                    k = int(rng.integers(len(new) + 1))
                    new[k : k + int(rng.integers(2))] = [str(rng.choice(vocabulary))] * int(rng.integers(2))
                lines.append(" ".join(new))
            text = " ".join(base)
            for changes in (1, 2, 3):
                for _ in range(changes):
                    k = int(rng.integers(1, len(text) - 1)) if len(text) > 2 else 0
                    text = text[:k] + ["", " ", "z"][int(rng.integers(3))] + text[k + 1 :]
                lines.append(text)
    lines = [x for x in dict.fromkeys(x.strip() for x in lines) if x]
    lines = [lines[k] for k in rng.permutation(len(lines))]
    expected = {k for k, x in enumerate(lines) if any(near_by_classes(y.encode(), x.encode()) for y in lines[:k])}
    docs = spark.createDataFrame(list(enumerate(lines)), SCHEMA)
    assert {r.doc_id for r in linededup.line_report(docs).collect() if r.n_removed} == expected
    assert len(expected) > 100


def test_near_rows_of_several_groups():
    rng = np.random.default_rng(6)
    texts = [rng.integers(97, 100, rng.integers(1, 9)).astype(np.int16) for _ in range(90)]
    size = np.array([len(t) for t in texts])
    begin = np.repeat([0, 1, 31, 60], [1, 30, 29, 30])
    side = np.concatenate([np.zeros(31, np.int64), rng.integers(0, 2, 59)])
    got = linededup.near_rows(np.concatenate(texts), np.cumsum(size) - size, size, begin, side, 2, most=100)
    for k in range(90):
        earlier = [j for j in range(begin[k], k) if k < 31 or side[j] != side[k]]
        assert got[k] == any(edits(texts[j], texts[k]) <= 2 for j in earlier)


def test_other_columns_and_string_ids(spark):
    texts = {"b": BASE + "\nsome line", "a": "some line\nX", "c": BASE.replace("lazy", "lzy") + "\nyet another", "": None}
    docs = spark.createDataFrame([(i, t, 111, "t1", "x", 7) for i, t in texts.items()] + [(None, "X\nlast of all", 111, "t1", "x", 7)], "doc_id string, text string, doc int, tie string, lines string, _doc int")
    got = linededup.without_repeated_lines(docs)
    assert got.columns == docs.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert {(r.doc, r.tie, r.lines, r["_doc"]) for r in rows.values()} == {(111, "t1", "x", 7)}
    assert {i: r.text for i, r in rows.items()} == {"a": texts["a"], "b": BASE, "c": "yet another", "": None, None: "last of all"}


def test_texts_that_share_an_id(spark):
    docs = spark.createDataFrame([(1, "one line here"), (1, "one line here\nand another"), (1, "one line here"), (2, "and another\nnew")], SCHEMA)
    got = linededup.line_report(docs).collect()
    assert sum(r.n_removed for r in got if r.doc_id == 1) in (1, 2) and sum(r.n_removed for r in got if r.doc_id == 2) == 1


def test_rows_of_shared_keys():
    rng = np.random.default_rng(7)
    for _ in range(20):
        key, line = rng.integers(0, 60, 150), rng.integers(0, 4, 150)
        found, got = linededup._Sharers(), set()
        for a in range(0, 150, 40):
            got |= set(zip(*(x.tolist() for x in found.add(key[a : a + 40], line[a : a + 40])), strict=True))
            assert len(found.key) == len(set(key[: a + 40].tolist()))
        lines = {k: set(line[key == k].tolist()) for k in key.tolist()}
        assert got == {(k, x) for k, many in lines.items() if len(many) > 1 for x in many}
