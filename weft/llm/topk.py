"""Exact search for the highest integer inner products with a pivot table.

The distances of every vector to a set of pivots are computed once and stored with it. By the triangle inequality the
largest difference of the distances of a query and a candidate to any pivot bounds their distance from below, and with
both norms it bounds their inner product from above. Candidates are evaluated in the order of their bounds, for a handful
of neighbouring queries at a time, until no bound left reaches the lowest score kept (Micó, Oncina and Vidal 1994). What
a bound leaves out can't be among the results, so these are exact.

Vectors are put into blocks by their nearest pivot. A first pass over a fixed number of rows (the sample from which the
pivots come) gives each query a score that its results must reach. Pairs of blocks whose ranges of distances show that
they hold no such score are dropped before any vector is sent; the queries of the others are sent to the blocks of rows,
each of which is sent once.

Defined results: vectors that are null or hold a null or non-finite component take no part; empty vectors do, with
scores of 0 among themselves; only vectors of equal length are compared; rows that repeat id and vector count once; a
query's own id is no candidate of it; null ids take no part. Scores must stay below 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.shared import map_texts, stored


def _packed(x: np.ndarray) -> bytes:
    """Small integers in two bytes each, others as doubles."""
    return x.astype("<i2" if not len(x) or np.abs(x).max() < 1 << 15 else "<f8").tobytes()


def integer_vectors(rows: DataFrame, id_column: str = "vec_id", column: str = "embedding", scale: int = 64) -> DataFrame:
    """``(vec_id, dim, v)``: floor(scale * component) of usable rows, packed."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("e")
            flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(float))
            ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
            parts = [_packed(x) for x in np.split(flat, ends[:-1])] if len(column) else []
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), column.value_lengths(), pa.array(parts, pa.binary())], names=["vec_id", "dim", "v"])

    chosen = rows.filter(F.col(id_column).isNotNull() & F.col(column).isNotNull()).filter(finite)
    return map_texts(chosen.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).alias("e")).distinct(), run, "vec_id long, dim int, v binary")


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``sample`` far from each other: each next one is the farthest from those before."""
    chosen = [int(np.argmax((sample**2).sum(1)))]
    nearest = ((sample - sample[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)):
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * x @ pivots.T, 0))


def search(q_ids: np.ndarray, q: np.ndarray, q_table: np.ndarray, floor: np.ndarray, x_ids: np.ndarray, x: np.ndarray, x_table: np.ndarray, k: int, group: int = 32, step: int = 1024) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query id, candidate id, score)`` of the best ``k`` of each query that score ``floor`` or more. The tables hold
    distances to pivots. A group of queries shares its bounds, which follow from the ranges of their distances."""
    q_norm, x_norm = (q**2).sum(1), (x**2).sum(1)
    by_pivot = np.ascontiguousarray(x_table.T)
    q_order = np.lexsort((np.sort(q_table, 1)[:, 0], q_table.argmin(1))) if q_table.shape[1] else np.arange(len(q))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.empty(0, np.int64),) * 3]
    for a in range(0, len(q), group):
        rows = q_order[a : a + group]
        lower = np.zeros(len(x), np.float32)
        for near, far, own in zip(q_table[rows].min(0), q_table[rows].max(0), by_pivot, strict=True):
            np.maximum(lower, own - far, out=lower)
            np.maximum(lower, near - own, out=lower)
        slack = 1e-5 * (1 + np.sqrt(q_norm[rows].max()) + np.sqrt(x_norm))  # distances are single floats
        lower = np.maximum(lower - slack, 0)
        upper = (q_norm[rows].max() + x_norm - lower**2) / 2
        order = np.argsort(-upper, kind="stable")
        upper = upper[order]
        top_score, top_id = np.full((len(rows), k), -np.inf), np.full((len(rows), k), np.iinfo(np.int64).max)
        worst = floor[rows].copy()
        for b in range(0, len(x), step):
            live = np.flatnonzero(worst <= upper[b])
            if not len(live):
                break
            part = order[b : b + step]
            score = q[rows[live]] @ x[part].T
            score[x_ids[part][None, :] == q_ids[rows[live], None]] = -np.inf
            better = score >= worst[live, None]
            some = np.flatnonzero(better.any(1))
            if not len(some):
                continue
            live, score = live[some], np.where(better[some], score[some], -np.inf)
            score = np.concatenate([top_score[live], score], 1)
            ids = np.concatenate([top_id[live], np.broadcast_to(x_ids[part], (len(live), len(part)))], 1)
            best = _best(score, ids, k)
            top_score[live], top_id[live] = np.take_along_axis(score, best, 1), np.take_along_axis(ids, best, 1)
            worst[live] = np.maximum(worst[live], top_score[live, -1])
        row, col = np.nonzero(top_score > -np.inf)
        found.append((q_ids[rows[row]], top_id[row, col], top_score[row, col].astype(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` highest scores of each row, ties to the smaller id, best first."""
    cut = -np.partition(-score, k - 1, 1)[:, k - 1]
    out = np.empty((len(score), k), np.int64)
    for r in range(len(score)):
        at = np.flatnonzero(score[r] >= cut[r])
        out[r] = at[np.lexsort((ids[r, at], -score[r, at]))[:k]]
    return out


def _unpacked(vectors: list[bytes], dim: int) -> np.ndarray:
    if not dim:
        return np.zeros((len(vectors), 0))
    if all(len(v) == 2 * dim for v in vectors):
        return np.frombuffer(b"".join(vectors), "<i2").reshape(len(vectors), dim).astype(float)
    return np.stack([np.frombuffer(v, "<i2" if len(v) == 2 * dim else "<f8").astype(float) for v in vectors])


def _table(rows: list[bytes]) -> np.ndarray:
    """Packed distances to pivots; a vector of a length that the sample lacks has none."""
    return np.frombuffer(b"".join(rows), "<f4").reshape(len(rows), -1) if any(rows) else np.zeros((len(rows), 0), np.float32)


def _pivot_table(vectors: DataFrame, by_dim: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """``vectors`` with their distances ``d`` to the pivots, the nearest one (``cell``) and, for queries, the score
    ``floor`` that ``k`` rows of the sample reach."""
    fixed = vectors.sparkSession.sparkContext.broadcast(by_dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x, ids = _unpacked(part.column("v").to_pylist(), int(dim)), part.column("vec_id").to_numpy()
                asks = part.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
                s_ids, s, pivots = fixed.value.get(int(dim), (ids[:0], x[:0], x[:0]))
                d = _distances(x, pivots).astype("<f4")
                floor = np.full(len(x), -np.inf)
                if len(s) > k and asks.any():
                    score = x[asks] @ s.T
                    score[s_ids[None, :] == ids[asks, None]] = -np.inf
                    floor[asks] = -np.partition(-score, k - 1, 1)[:, k - 1]
                cell = d.argmin(1) if d.shape[1] else np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("vec_id", "dim", "v", "is_query")), pa.array([r.tobytes() for r in d], pa.binary()), pa.array(cell.astype(np.int32)), pa.array(floor)], names=["vec_id", "dim", "v", "is_query", "d", "cell", "floor"])

    return map_texts(vectors, run, "vec_id long, dim int, v binary, is_query boolean, d binary, cell int, floor double")


def _blocks(table: DataFrame, name: str, size: int) -> DataFrame:
    """Blocks of about ``size`` rows of one cell: their packed rows, and the ranges of their distances and norms."""
    n = stored(table.groupBy("dim", "cell").agg(F.ceil(F.count("*") / size).cast("int").alias("n")), "cells")
    block = F.xxhash64("dim", "cell", F.pmod(F.xxhash64("vec_id", "v"), F.col("n"))).alias(name)
    cells = table.join(n, ["dim", "cell"]).groupBy("dim", block).agg(F.collect_list(F.struct("vec_id", "v", "d", "floor")).alias("r"))
    flat = cells.select("dim", name, F.col("r.vec_id").alias("ids"), F.col("r.v").alias("v"), F.col("r.d").alias("d"), F.col("r.floor").alias("floors"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                d = _table(r["d"])
                norm = (_unpacked(r["v"], r["dim"]) ** 2).sum(1).max()
                cols = [[r["dim"]], [r[name]], [r["ids"]], [r["v"]], [r["d"]], [r["floors"]], [d.min(0).tolist()], [d.max(0).tolist()], [norm], [min(r["floors"])]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    names = ["dim", name, f"{name}_ids", f"{name}_v", f"{name}_d", f"{name}_floors", f"{name}_low", f"{name}_high", f"{name}_norm", f"{name}_floor"]
    kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.float64()]
    sql = ["int", "long", "array<long>", "array<binary>", "array<binary>", "array<double>", "array<double>", "array<double>", "double", "double"]
    return map_texts(flat, run, ", ".join(f"{c} {t}" for c, t in zip(names, sql, strict=True)))


def _meets(queries: DataFrame, rows: DataFrame) -> DataFrame:
    """``(q, x)``: pairs of blocks that may hold a result, by the ranges of their distances to pivots."""
    pairs = queries.select("dim", "q", "q_low", "q_high", "q_norm", "q_floor").join(rows.select("dim", "x", "x_low", "x_high", "x_norm"), "dim")
    gap = F.transform(F.sequence(F.lit(1), F.size("q_low")), lambda p: F.greatest(F.element_at("q_low", p) - F.element_at("x_high", p), F.element_at("x_low", p) - F.element_at("q_high", p), F.lit(0.0)))
    lower = F.when(F.size("q_low") > 0, F.array_max(gap)).otherwise(0.0)
    slack = F.lit(1e-5) * (1 + F.sqrt("q_norm") + F.sqrt("x_norm"))
    upper = (F.col("q_norm") + F.col("x_norm") - F.pow(F.greatest(lower - slack, F.lit(0.0)), F.lit(2.0))) / 2
    return pairs.filter(upper >= F.col("q_floor")).select("q", "x")


def top_scores(rows: DataFrame, is_query: Column, k: int = 20, n_pivots: int = 32, sample_rows: int = 2048, query_block: int = 1024, row_block: int = 8192) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest inner products of each row that ``is_query`` holds for."""
    vectors = stored(integer_vectors(rows), "vectors")
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample_rows).collect()
    by_dim: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for dim in {r.dim for r in sample}:
        own = [r for r in sample if r.dim == dim]
        x = _unpacked([r.v for r in own], dim)
        by_dim[dim] = (np.array([r.vec_id for r in own], np.int64), x, choose_pivots(x, n_pivots))
    table = stored(_pivot_table(vectors.withColumn("is_query", F.coalesce(is_query, F.lit(False))), by_dim, k), "pivot-table")
    queries, blocks = stored(_blocks(table.filter("is_query"), "q", query_block), "query-blocks"), stored(_blocks(table, "x", row_block), "row-blocks")
    meets = stored(_meets(queries, blocks), "meets")
    tasks = 1 + blocks.count() // 2
    sent = meets.join(queries.select("dim", "q", "q_ids", "q_v", "q_d", "q_floors"), "q").repartition(tasks, "x")
    met = sent.join(blocks.select("x", "x_ids", "x_v", "x_d").hint("shuffle_hash"), "x").drop("q", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in (batch.slice(at, 1).to_pylist()[0] for at in range(batch.num_rows)):
                parts = []
                for s in "qx":
                    ids = np.array(r[f"{s}_ids"], np.int64)
                    parts.append((ids, _unpacked(r[f"{s}_v"], r["dim"]), _table(r[f"{s}_d"])))
                query, vec, score = search(*parts[0], np.array(r["q_floors"]), *parts[1], k)
                yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(vec), pa.array(score)], names=["query_id", "vec_id", "score"])

    found = map_texts(met, run, "query_id long, vec_id long, score long").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
