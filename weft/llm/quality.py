"""Quality scores from random-indexing word vectors and a two-layer network.

Each whitespace-separated token stands for two vocabulary entries: its bytes, and its shape (the collapsed sequence of
character classes, apart if it repeats the token before). The table of entries has a fixed size: the most frequent
tokens, by counts over all documents, have rows of their own, and rarer ones share hashed rows, as shapes do. Every row
has a sparse random index vector; an entry's word vector is the sum of the index vectors of the tokens within two places
of it, over all documents (Kanerva, Kristoferson and Holst 2000), brought to unit length. A document is the
mean and spread of its tokens' vectors, and its length. A network with one hidden layer, trained in numpy, scores it; a
temperature fitted on rows apart calibrates the probabilities.

The network is fitted on at most ``max_fit_rows`` labelled rows (documented bound, 20,000, chosen by hash of the id).
Counts and word vectors use all documents: each task sums its own table, so what is shuffled grows with the number of
tasks, and the table that is fetched has a fixed number of rows.

Defined results: null and empty texts have no tokens and get the score of the zero vector; rows keep their
multiplicity; null labels, null ids and labels of unknown documents are ignored; of an id with several labels each
teaches, as does each text of an id; without usable labels of both classes each score is the share of class 1 among them
(0.5 if none).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm import textbytes as tb
from weft.llm.shared import crc32_of_id, drop_stored, map_texts, stored
from weft.llm.toxicity import labelled_sample

#: Rows of frequent words, of other words, and of shapes.
OWN, WORDS, SHAPES, DIM, NONZERO = 16384, 8192, 1024, 32, 2
ROWS = OWN + WORDS + SHAPES
#: How often a word stands in all documents, to be counted as frequent.
LEAST_COUNT = 10
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = _CLASS[128:] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero parts of each row's index vector, fixed for all runs."""
    h = tb.mix(np.arange(ROWS * NONZERO, dtype=tb.U64), 99).reshape(ROWS, NONZERO)
    return (h % tb.U64(DIM)).astype(np.int64), np.where(h >> tb.U64(63), 1.0, -1.0)


def _token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    start, end = tb.spans(data > 32, offsets)
    return start, end, tb.RangeHash(data)(start, end)


def frequent_words(docs: DataFrame, most: int = OWN, least_count: int = LEAST_COUNT) -> np.ndarray:
    """Hashes of the most frequent tokens over all documents, ``most`` at most; ascending.

    They are those above a count, which follows from how many tokens have each order of magnitude of count; so no task
    sorts all tokens, and the driver gets a fixed number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for whole in batches:
            for _, data, offsets in tb.slices(whole, most=1 << 20):
                held.append(np.unique(_token_hashes(data, offsets)[2], return_counts=True))
                n += len(held[-1][0])
                if n > 1 << 20:
                    yield summed(held)
                    held, n = [], 0
        if held:
            yield summed(held)

    def summed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        h, back = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
        n = np.bincount(back, np.concatenate([x[1] for x in held])).astype(np.int64) if len(h) else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    parts = map_texts(docs.select("text"), run, "h long, n long")
    counts = stored(parts.groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count).withColumn("size", F.floor(F.log2("n") * 16).cast("int")), "word-counts")
    total, size = 0, None
    for r in counts.groupBy("size").count().orderBy(F.desc("size")).collect():
        total += r["count"]
        if total > most:
            break
        size = r["size"]
    if size is None:
        return np.empty(0, tb.U64)
    return np.sort(counts.filter(F.col("size") >= size).select("h").toArrow()["h"].to_numpy().view(tb.U64))


def tokens(data: np.ndarray, offsets: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table rows of each token's bytes and shape, and the token bounds of each text."""
    start, end, h = _token_hashes(data, offsets)
    bounds = np.searchsorted(start, offsets)
    kind = _CLASS[data]
    turn = np.ones(len(data), bool)
    turn[1:] = kind[1:] != kind[:-1]
    turn[start] = True
    place = np.concatenate([[0], np.cumsum(turn)])
    shape = tb.RangeHash(kind[turn])(place[start], place[end])
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    again[bounds[:-1][bounds[:-1] < len(h)]] = False
    shape = tb.mix(shape, 5) + again * tb.U64(1 << 60)
    word = OWN + (h % tb.U64(WORDS)).astype(np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
        word = np.where(frequent[at] == h, at, word)
    return word, OWN + WORDS + (tb.mix(shape, 6) % tb.U64(SHAPES)).astype(np.int64), bounds


def add_contexts(table: np.ndarray, data: np.ndarray, offsets: np.ndarray, places: np.ndarray, signs: np.ndarray, frequent: np.ndarray) -> None:
    word, shape, bounds = tokens(data, offsets, frequent)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for step in (1, 2):
        left, right = np.arange(len(word) - step), np.arange(step, len(word))
        same = row[left] == row[right]
        left, right = left[same], right[same]
        for entry in (word, shape):
            own, seen = np.concatenate([entry[left], entry[right]]), np.concatenate([entry[right], entry[left]])
            cell = (own * DIM)[:, None] + places[seen]
            table += np.bincount(cell.ravel(), signs[seen].ravel(), ROWS * DIM)


def word_vectors(docs: DataFrame, frequent: np.ndarray) -> np.ndarray:
    """The unit word vectors of all table rows, summed over every document."""
    names = [f"c{k}" for k in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        table, most = np.zeros(ROWS * DIM), 1 << 20
        for whole in batches:
            for _, data, offsets in tb.slices(whole, most=most):
                add_contexts(table, data, offsets, places, signs, frequent)
        rows = table.reshape(ROWS, DIM)
        used = np.flatnonzero(rows.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(rows[used, k].astype(np.int64)) for k in range(DIM))], names=["row", *names])

    parts = map_texts(docs.select("text"), run, "row long, " + ", ".join(f"{c} long" for c in names))
    found = parts.groupBy("row").agg(*(F.sum(c).alias(c) for c in names)).toArrow()
    table = np.zeros((ROWS, DIM))
    table[found["row"].to_numpy()] = np.column_stack([found[c].to_numpy() for c in names])
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Mean and spread of the vectors of each text's tokens, and its logarithmic length."""
    word, shape, bounds = tokens(data, offsets, frequent)
    n = np.diff(bounds)
    out = np.zeros((len(n), 4 * DIM + 1), np.float32)
    full = np.flatnonzero(n)
    for k, entry in enumerate((word, shape)):
        x = vectors[entry]
        if len(full):
            mean = np.add.reduceat(x, bounds[full]) / n[full, None]
            square = np.add.reduceat(x * x, bounds[full]) / n[full, None]
            out[full, 2 * k * DIM : (2 * k + 1) * DIM] = mean
            out[full, (2 * k + 1) * DIM : (2 * k + 2) * DIM] = np.sqrt(np.maximum(square - mean**2, 0))
    out[:, -1] = np.log1p(n)
    return out


class Network:
    """Standardised inputs, one hidden layer of tanh units, one output, trained with Adam; then a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, calibrate: np.ndarray, hidden: int = 32, epochs: int = 40, rate: float = 3e-3, decay: float = 1e-4):
        self.constant = None
        if len(set(y[~calibrate].tolist())) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        rng, train = np.random.default_rng(7), np.flatnonzero(~calibrate)
        self.mean, self.scale = x[train].mean(0), x[train].std(0) + 1e-3
        z = self._standard(x)
        self.w = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in self.w], [np.zeros_like(a) for a in self.w], 0
        for epoch in range(epochs):
            for part in np.array_split(rng.permutation(train), max(1, len(train) // 256)):
                h = np.tanh(z[part] @ self.w[0] + self.w[1])
                d = (1 / (1 + np.exp(-(h @ self.w[2] + self.w[3]))) - y[part]) / len(part)
                back = np.outer(d, self.w[2]) * (1 - h * h)
                grads = [z[part].T @ back + decay * self.w[0], back.sum(0), h.T @ d + decay * self.w[2], np.array([d.sum()])]
                step += 1
                for a, g, mi, vi in zip(self.w, grads, m, v, strict=True):
                    mi += 0.1 * (g - mi)
                    vi += 0.001 * (g * g - vi)
                    a -= rate * (1 - epoch / epochs) * (mi / (1 - 0.9**step)) / (np.sqrt(vi / (1 - 0.999**step)) + 1e-8)
        part = calibrate if calibrate.any() else ~calibrate
        raw, target = self._raw(x[part]), y[part]
        grid = np.exp(np.linspace(-2, 3, 101))
        loss = [np.logaddexp(0, np.where(target == 1, -raw, raw) / t).mean() for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def _raw(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self._standard(x) @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self._raw(x) / self.temperature, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, frequent: np.ndarray, held_out: Column, label: str = "quality", max_fit_rows: int = 20_000) -> Network:
    """A fifth of the sample (by hash of the id) calibrates, the rest trains."""
    sample = stored(labelled_sample(docs, labels, label, held_out, max_fit_rows), "quality-sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, data, offsets in tb.slices(whole):
                x = pooled(data, offsets, vectors, frequent).astype("<f4")
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), batch.column("y"), batch.column("part")], names=["x", "y", "part"])

    rows = map_texts(sample, run, "x binary, y double, part int").toArrow()
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), "<f4").reshape(rows.num_rows, 4 * DIM + 1).astype(float)
    y, part = rows["y"].to_numpy(), rows["part"].to_numpy()
    order = np.lexsort([*x.T, y]) if len(x) else np.empty(0, int)
    drop_stored(docs.sparkSession, sample)
    return Network(x[order], y[order], part[order] >= 8)


def learnt_split() -> Column:
    """True for held-out documents, from which no label is learnt."""
    return F.coalesce(crc32_of_id() % 3 == 1, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, max_fit_rows: int = 20_000) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted. Labels are learnt where crc32(doc_id) mod 3 is not 1."""
    frequent = frequent_words(docs)
    vectors = word_vectors(docs, frequent)
    kept = pickle.dumps((vectors, frequent, fit(docs, labels, vectors, frequent, learnt_split(), max_fit_rows=max_fit_rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, frequent, network = pickle.loads(kept)
        for whole in batches:
            for batch, data, offsets in tb.slices(whole):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(network.score(pooled(data, offsets, vectors, frequent)))], names=["doc_id", "score"])

    scored = map_texts(docs.select("doc_id", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", learnt_split().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
