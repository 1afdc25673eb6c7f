"""Exact-verified Jaccard self-join of word n-gram sets by the chosen-path method.

1. Each text becomes the set of its runs of ``size`` words (all its words, if fewer); texts with one set are one node.
   A set is embedded as ``WIDTH`` minimum hashes, two of which agree with the probability of the Jaccard similarity.
2. In each of several runs every node starts at the root of a random tree (Christiani and Pagh 2017). A tree node picks
   one or two places of the embedding by its own hash, 1 / 0.8 on average, and sends each set to the children named by
   the values found there, so sets of a similarity of 0.8 keep meeting in about one child. After ``depth`` steps, sets
   that meet are a bucket; buckets of more than ``limit`` sets are split further.
3. Small buckets are compared by brute force on the embedding, far below the threshold, and linked by a spanning
   forest; its components are groups of candidates.
4. Each group is compared by exact intersections of whole sets. Groups of more than ``BLOCK`` sets are compared by pairs
   of blocks, so no task ever holds a group. Counts and forests of links leave a task, never the pairs.

The number of runs follows from ``recall``, the chance that a pair at the threshold meets and is linked, over all numbers of
places in which its embeddings may agree.

Defined results: texts without words, null ones among them, are in no set: a class of their own, no links. Rows with a
null id get no class and no links, and give none. Repeated rows are copies of each other; texts that bear one id are rows
of their own, so two classes may be named by the same id. Ids may be of any type with an order. Other columns are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm import textbytes as tb
from weft.llm.shared import components, map_texts, stored

WIDTH, BLOCK = 64, 256
#: Sets of a bucket are linked if the share of places in which their embeddings agree is this part of the threshold.
AGREE = 0.7
_FACTORS = tb.mix(np.arange(WIDTH, dtype=tb.U64), 41) | tb.U64(1)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """``(doc_id, version, node, n, sketch)`` for each row of ``docs(doc_id, version, text)``: hash and size of its set,
    and its embedding. Without words n is 0."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, data, offsets in tb.slices(whole):
                h, bounds = tb.shingle_sets(tb.words_of(data, offsets), size)
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                least = np.zeros((len(n), WIDTH), np.uint32)
                node = np.zeros(len(n), tb.U64)
                if len(full):
                    at = bounds[full]
                    node[full] = tb.mix(np.add.reduceat(tb.mix(h, 51), at) ^ np.add.reduceat(tb.mix(h, 52), at) * tb.U64(3), 53)
                    for k in range(WIDTH):
                        least[full, k] = np.minimum.reduceat(h * _FACTORS[k], at) >> tb.U64(32)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("version"), _long(node), pa.array(n), pa.array([r.tobytes() for r in least], pa.binary())], names=["doc_id", "version", "node", "n", "sketch"])

    return map_texts(docs, run, f"doc_id {id_type}, version long, node long, n long, sketch binary")


def _descend(path: np.ndarray, row: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Children of tree nodes ``path``, which the sets in ``row`` have reached."""
    draw = tb.mix(path, 61)
    two = np.flatnonzero((draw & tb.U64(3)) == 0)
    first = (draw >> tb.U64(8)) % tb.U64(WIDTH)
    second = (first[two] + tb.U64(1) + (draw[two] >> tb.U64(32)) % tb.U64(WIDTH - 1)) % tb.U64(WIDTH)
    place = np.concatenate([first, second]).astype(np.int64)
    path, row = np.concatenate([path, path[two]]), np.concatenate([row, row[two]])
    return tb.mix(path ^ tb.mix(sketch[row, place].astype(tb.U64) * tb.U64(WIDTH) + place.astype(tb.U64), 62), 63), row


def _survival(similarity: float, depth: int) -> float:
    """Chance that two sets of a similarity still meet somewhere after ``depth`` steps of one run."""
    kept = 1.0
    for _ in range(depth):
        lost = 1 - similarity * kept
        kept = 1 - 0.75 * lost - 0.25 * lost**2
    return kept


def expected_recall(runs: int, similarity: float, depth: int) -> float:
    """Chance that a pair meets and agrees in enough places of the embedding to be linked. All runs descend on the same
    embedding, so they are independent only once the number of places that agree is given."""
    share = lambda k: math.comb(WIDTH, k) * similarity**k * (1 - similarity) ** (WIDTH - k)
    return sum(share(k) * (1 - (1 - _survival(k / WIDTH, depth)) ** runs) for k in range(math.ceil(AGREE * similarity * WIDTH), WIDTH + 1))


def runs_for(recall: float, similarity: float, depth: int, most: int = 1000) -> int:
    """The least number of runs that reach ``recall`` for a pair of this similarity."""
    found = next((k for k in range(1, most) if expected_recall(k, similarity, depth) >= recall), None)
    if not found:
        raise ValueError(f"an embedding of {WIDTH} places can't reach a recall of {recall}")
    return found


def _leaves(nodes: DataFrame, depth: int, runs: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(-1, WIDTH)
                row = np.tile(np.arange(len(sketch)), runs)
                path = np.repeat(tb.mix(np.arange(runs, dtype=tb.U64), 64), len(sketch))
                for _ in range(depth):
                    path, row = _descend(path, row, sketch)
                found = np.unique(np.column_stack([path.view(np.int64), row]), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(batch.column("node").to_numpy()[found[:, 1]])], names=["path", "node"])

    return map_texts(nodes.select("node", "sketch"), run, "path long, node long")


def _children(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(-1, WIDTH)
                path, row = _descend(batch.column("path").to_numpy().view(tb.U64), np.arange(len(sketch)), sketch)
                yield pa.RecordBatch.from_arrays([_long(path), pa.array(batch.column("node").to_numpy()[row])], names=["path", "node"])

    return map_texts(rows.select("path", "node", "sketch"), run, "path long, node long")


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges from the first node of each component of a symmetric 0/1 matrix to its others.

    As nodes are in ascending order, components in different buckets or blocks tend to have the same first node, so
    few edges differ."""
    left, out = np.ones(len(linked), bool), []
    while left.any():
        root = int(np.argmax(left))
        left[root], edge = False, [root]
        while edge:
            x = edge.pop()
            new = np.flatnonzero(linked[x] & left)
            left[new] = False
            out += [(root, int(y)) for y in new]
            edge += new.tolist()
    return out


def _groups(column: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each value of ``column`` in turn, of batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        x = batch.column(column).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(x[1:] != x[:-1]) + 1).tolist(), len(x)] if len(x) else [0]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and held[0].column(column)[0].as_py() != x[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _bucket_edges(rows: DataFrame, least: float) -> DataFrame:
    """Spanning forests of the sets in each bucket whose embeddings agree in ``least`` of their places or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups("path", batches):
            node = t["node"].to_numpy()
            order = np.argsort(node)
            node, sketch = node[order], np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint32).reshape(-1, WIDTH)[order]
            agree = np.zeros((len(node), len(node)), np.uint8)
            for k in range(WIDTH):
                agree += sketch[:, k, None] == sketch[None, :, k]
            edges = _forest(agree >= least * WIDTH)
            if edges:
                a, b = np.array(edges).T
                yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

    return map_texts(rows.repartition("path").sortWithinPartitions("path").select("path", "node", "sketch"), run, "a long, b long")


def candidate_edges(nodes: DataFrame, similarity: float, recall: float, depth: int, limit: int, max_depth: int) -> DataFrame:
    """Edges ``(a, b)`` between nodes whose components hold every pair that met in a bucket.

    A node has at most one edge from each bucket that it is in. It keeps that from the least of the first nodes of these
    buckets, and the others are linked to this one directly, so a group has about as many edges as nodes."""
    sketch = nodes.select("node", "sketch")
    rows, found = _leaves(nodes, depth, runs_for(recall, similarity, max_depth)), None
    for level in range(depth, max_depth + 1):
        sizes = stored(rows.groupBy("path").agg(F.count("*").alias("members"), F.min("node").alias("least")).filter("members > 1"), "bucket-sizes")
        met = stored(rows.join(sizes, "path").hint("rebalance"), "buckets")
        edges = _bucket_edges(met.filter(F.col("members") <= limit).join(sketch, "node"), similarity * AGREE)
        large = met.filter(F.col("members") > limit)
        if level == max_depth:
            edges = edges.unionByName(large.select(F.col("least").alias("a"), F.col("node").alias("b")))
        found = edges if found is None else found.unionByName(edges)
        if level == max_depth or not large.limit(1).count():
            break
        rows = _children(large.join(sketch, "node"))
    firsts = found.groupBy("b").agg(F.collect_set("a").alias("firsts")).withColumn("a", F.array_min("firsts"))
    edges = firsts.select("a", F.explode(F.array_append("firsts", F.col("b"))).alias("b")).filter("a <> b")
    return stored(edges.distinct(), "candidates")


def _labels(linked: np.ndarray) -> np.ndarray:
    """The first node of the component of each node of a symmetric 0/1 matrix."""
    out = np.arange(len(linked))
    for a, b in _forest(linked):
        out[b] = a
    return out


def _links(parts: DataFrame, threshold: Fraction) -> DataFrame:
    """Per task and node: number of documents linked, and forest edges; ``b`` is null in rows that count.

    A task of two blocks links components of one to components of the other, as their own edges come from the tasks of
    the blocks alone. Edges so stay near the number of nodes and of pairs of blocks."""
    names = ["a", "b", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups("task", batches):
            node, copies, second = (t[c].to_numpy() for c in ("node", "copies", "side"))
            order = np.argsort(node)
            node, copies, second = node[order], copies[order], second[order]
            sets = [np.frombuffer(t["tokens"][int(k)].as_py(), np.uint64) for k in order]
            n = np.array([len(x) for x in sets])
            token = np.unique(np.concatenate(sets), return_inverse=True)[1]
            often = np.bincount(token) > 1
            column = np.cumsum(often) - 1
            row = np.repeat(np.arange(len(sets)), n)[often[token]]
            column = column[token[often[token]]]
            by_column = np.argsort(column, kind="stable")
            row, column = row[by_column], column[by_column]
            common = np.zeros((len(sets), len(sets)), np.float32)
            width = max(512, (1 << 21) // len(sets))
            for a in range(0, int(often.sum()), width):
                x, y = np.searchsorted(column, [a, a + width])
                part = np.zeros((len(sets), min(width, int(often.sum()) - a)), np.float32)
                part[row[x:y], column[x:y] - a] = 1
                common += part @ part.T
            common = common.astype(np.int64)
            linked = common * (threshold.numerator + threshold.denominator) >= threshold.numerator * (n[:, None] + n[None, :])
            np.fill_diagonal(linked, False)
            shown = np.arange(len(node))
            if second.any():
                across = second[:, None] != second[None, :]
                shown = _labels(linked & ~across)
                linked &= across
            links = linked @ copies
            some = np.flatnonzero(links)
            if len(some):
                root, of = np.unique(shown, return_inverse=True)
                between = np.zeros((len(root), len(root)), bool)
                x, y = np.nonzero(linked)
                between[of[x], of[y]] = True
                edges = root[np.array(_forest(between)).T]
                a, b = node[some], np.concatenate([np.zeros(len(some), np.int64), node[edges[1]]])
                null = np.concatenate([np.ones(len(some), bool), np.zeros(edges.shape[1], bool)])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, node[edges[0]]])), pa.array(b, mask=null), pa.array(np.concatenate([links[some], np.zeros(edges.shape[1], np.int64)]))], names=names)

    return map_texts(parts, run, "a long, b long, links long")


def _token_rows(docs: DataFrame, size: int) -> DataFrame:
    """The whole sets of documents that stand for a node, with the other columns of ``docs``."""
    rest = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, data, offsets in tb.slices(whole):
                h, bounds = tb.shingle_sets(tb.words_of(data, offsets), size)
                tokens = [h[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), pa.array(tokens, pa.binary())], names=[*(f.name for f in rest), "tokens"])

    return map_texts(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest) + ", tokens binary")


def versioned(docs: DataFrame) -> DataFrame:
    """``docs`` with ``version``, a hash of the text, which tells apart texts that bear one id."""
    return docs.withColumn("version", F.xxhash64("text"))


def near_duplicates(docs: DataFrame, size: int = 5, threshold: float = 0.8, recall: float = 0.9999, depth: int = 3, limit: int = 400, max_depth: int = 6) -> DataFrame:
    """Per row of ``docs``: doc_id, class_id (least id reached over links), n_links (rows whose set is similar enough,
    copies among them), version, node (the hash of its set) and chosen, whether this text stands for its class."""
    docs = versioned(docs.select("doc_id", "text"))
    each = stored(sketches(docs, size), "sketches")
    known = each.filter("n > 0 and doc_id is not null")
    nodes = known.groupBy("node").agg(F.min(F.struct("doc_id", "version")).alias("of"), F.count("*").alias("copies"), F.first("sketch").alias("sketch"))
    nodes = stored(nodes.select("node", F.col("of.doc_id").alias("least_id"), F.col("of.version").alias("version"), "copies", "sketch"), "nodes")
    groups = components(candidate_edges(nodes, threshold, recall, depth, limit, max_depth))
    large = stored(groups.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).filter("blocks > 1"), "large-groups")
    sized = groups.join(large, "component", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    members = sized.join(nodes.drop("sketch"), "node").select("node", F.col("least_id").alias("doc_id"), "version", "copies", "component", "blocks", block)
    texts = docs.join(members.hint("shuffle_hash"), ["doc_id", "version"])
    texts = texts.dropDuplicates(["node"]) if known.groupBy("doc_id", "version").count().filter("count > 1").limit(1).count() else texts
    sets = _token_rows(texts, size)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tasks = sets.select("node", "copies", "tokens", "component", "block", other).select(
        F.xxhash64("component", F.least("block", "other"), F.greatest("block", "other")).alias("task"), "node", "copies", "tokens", (F.col("block") > F.col("other")).cast("int").alias("side")
    )
    found = stored(_links(tasks.repartition("task").sortWithinPartitions("task"), Fraction(threshold).limit_denominator(1000)), "links")
    classes = components(found.filter("b is not null").select("a", "b"))
    counts = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    first = F.min(F.struct(F.col("least_id").alias("class_id"), "node")).alias("first")
    least = classes.join(nodes.select("node", "least_id"), "node").groupBy("component").agg(first).select("component", "first.class_id", F.col("first.node").alias("first"))
    by_node = nodes.drop("sketch").join(classes.join(least, "component").drop("component"), "node", "left").join(counts, "node", "left")
    links = (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    first = F.coalesce(F.col("first") == F.col("node"), F.lit(True)).alias("first")
    # stored, so that a node of very many copies can be split in the join with their rows
    by_node = stored(by_node.select("node", F.coalesce("class_id", "least_id").alias("class_id"), links, F.col("version").alias("shown"), F.col("least_id").alias("shown_id"), first), "by-node")
    chosen = (F.col("first") & (F.col("doc_id") == F.col("shown_id")) & (F.col("version") == F.col("shown"))).alias("chosen")
    joined = known.select("doc_id", "version", "node").join(by_node, "node").select("doc_id", "class_id", "n_links", "version", "node", chosen)
    alone = each.filter("n = 0 or doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), "version", F.lit(None).cast("long").alias("node"), F.lit(True).alias("chosen"))
    return joined.unionByName(alone)


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class: of its least id and, among that id's texts, of one text; repeats of this row
    go. Rows without words or without an id stay."""
    found = stored(near_duplicates(docs, **options).select("doc_id", "version", "node", "chosen"), "chosen")
    aside = {"_version": "_own_version"} if "_version" in docs.columns else {}
    named = docs.withColumnsRenamed(aside).withColumn("_version", F.xxhash64("text"))
    key = [F.col("doc_id"), F.col("version").alias("_version")]
    gone = found.filter("not chosen").select(*key).distinct()
    kept = named.join(gone.hint("shuffle_hash"), ["doc_id", "_version"], "left_anti")
    again = found.filter("chosen and node is not null").groupBy(*key).count().filter("count > 1")
    if again.limit(1).count():
        twice = again.drop("count")
        once = kept.join(twice, ["doc_id", "_version"], "left_semi").dropDuplicates(["doc_id", "_version"])
        kept = kept.join(twice, ["doc_id", "_version"], "left_anti").unionByName(once)
    return kept.select(*(F.col(aside.get(c, c)).alias(c) for c in docs.columns))
