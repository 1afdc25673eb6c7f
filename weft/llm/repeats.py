"""Removal of long repeated byte strings with sharded suffix arrays.

Every byte that lies in a string of ``length`` bytes which also starts earlier (in a document of smaller id, or in the
same one at an earlier place) is removed, all but the first occurrence of each string.

1. Each start of such a string is dealt by content: of the ``gram``-byte grams in the string, the one of least hash is
   its anchor (winnowing; Schleimer, Wilkerson and Aiken 2003). Successive starts with one anchor form a piece, or
   several of at most ``_MOST`` starts, cut at fixed distances from the anchor. Equal strings have equal anchors at equal
   places, so they can only lie in pieces of the same anchor and distance. Tasks drop further copies of a piece before
   the shuffle, so the copies of a hot passage shrink to one row a task.
2. Pieces are sorted by anchor and content and streamed: all copies of a piece but the first are removed. Pieces whose
   anchor has no other content are done.
3. For the others the bytes are fetched and dealt by anchor into shards. An anchor of more than ``hot_bytes`` is split
   over several. Each shard gets a suffix array by induced sorting and permuted common prefixes; runs of suffixes that
   share ``length`` bytes are the classes of equal strings. In split shards the first string of each class goes through
   step 2 once more, under its hash.
4. The removed starts are gathered by document and cut out of its text.

Memory is bounded by a shard or by the longest text. Defined results: null texts are empty; a null id comes after all
others; ids may be of any type with an order; rows that repeat id and text are one document, and each gets its result;
texts that share an id are ordered by a hash of the text; no other column is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from weft.llm import textbytes as tb
from weft.llm.shared import map_texts, stored
from weft.llm.suffixes import permuted_lcp, suffix_array

_MOST = 126  # starts in a piece
_DONE = 127  # in place of a piece's number of starts: the row's removal is known already
_LAST_ID = (1 << 63) - 1


def pieces(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, row, first start and number of starts of each piece."""
    n, width = len(data), length - gram + 1
    none = np.empty(0, np.int64)
    if n < length:
        return none.view(tb.U64), none.view(tb.U64), none, none, none
    ranges = tb.RangeHash(data)
    at = np.arange(n - gram + 1)
    h = ranges(at, at + gram)
    low = tb.U64((1 << 20) - 1)
    best, span = (h & ~low) | (at.astype(tb.U64) & low), 1
    while span * 2 <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    best = np.minimum(best[: len(h) - width + 1], best[width - span : len(h) - span + 1])
    room = np.maximum(np.diff(offsets) - length + 1, 0)
    row = np.repeat(np.arange(len(room)), room)
    start = np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room)
    place = start + offsets[row]
    anchor = (best[place] & low).astype(np.int64)
    apart = (anchor - place) // _MOST
    new = np.ones(len(place), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (apart[1:] != apart[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(place)))
    begin = place[first]
    return h[anchor[first]] + apart[first].astype(tb.U64) * tb.U64(0x9E3779B97F4A7C15), ranges(begin, begin + count - 1 + length, 1), row[first], start[first], count


def _packed(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (start << 7) | count


def _segments(batch: pa.RecordBatch, length: int, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes and offsets of texts, with their row in ``batch`` and base; a long text comes in overlapping parts."""
    row = 0
    for part, data, offsets in tb.slices(batch, most=most):
        rows = np.arange(row, row + part.num_rows)
        row += part.num_rows
        if part.num_rows == 1 and len(data) > 2 * most:
            for base in range(0, len(data), most):
                piece = data[base : base + most + length - 1]
                yield piece, np.array([0, len(piece)]), rows, np.array([base])
        else:
            yield data, offsets, rows, np.zeros(part.num_rows, np.int64)


def _joined(doc: np.ndarray, tie: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of starts, with those of a document that touch made one."""
    order = np.lexsort((a, tie, doc))
    doc, tie, a, b = doc[order], tie[order], a[order], b[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (a[1:] > b[:-1])
    first = np.flatnonzero(new)
    return doc[first], tie[first], a[first], np.maximum.reduceat(b, first) if len(first) else b


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Which rows differ from the one before in some column; the first does."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = False
    for x in columns:
        out[1:] |= x[1:] != x[:-1]
    return out


def _piece_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    names = ["key", "content", "doc", "tie", "place"]

    def flush(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        key, content, doc, tie, place = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((place, tie, doc, content, key))
        key, content, doc, tie, place = (x[order] for x in (key, content, doc, tie, place))
        new = _changes(key, content)
        gone = ~new & _changes(doc, tie, place)
        out = [x[new] for x in (key, content, doc, tie, place)]
        start = place[gone] >> 7
        d, t, a, b = _joined(doc[gone], tie[gone], start, start + (place[gone] & 127))
        more = [d, b, d, t, _packed(a, np.full(len(a), _DONE))]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x.view(np.int64), y])) for x, y in zip(out, more, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ids, ties = batch.column("doc").to_numpy(), batch.column("tie").to_numpy()
            for data, offsets, rows, base in _segments(batch, length):
                key, content, row, start, count = pieces(data, offsets, length, gram)
                held.append((key.view(np.int64), content.view(np.int64), ids[rows[row]], ties[rows[row]], _packed(start + base[row], count)))
                n += len(key)
            if n > 1_000_000:
                yield from flush(held)
                held, n = [], 0
        if n:
            yield from flush(held)

    return map_texts(docs.select("doc", "tie", "text"), run, ", ".join(f"{x} long" for x in names))


def _first_pieces(rows: DataFrame) -> DataFrame:
    """Streams pieces by anchor and content: rows ``(key, doc, tie, a, b)``, with a null key for removed starts and the
    anchor for first copies of pieces whose anchor has several contents. Between batches only one piece is held."""
    names = ["key", "doc", "tie", "a", "b"]

    def out(key: np.ndarray | None, doc, tie, a, b) -> pa.RecordBatch:
        head = pa.nulls(len(doc), pa.int64()) if key is None else pa.array(key)
        return pa.RecordBatch.from_arrays([head, *(pa.array(x) for x in (doc, tie, a, b))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # key, content, doc, tie, place of the last row seen
        held, shared = None, False  # the last first copy, and whether its anchor has others before it
        for batch in batches:
            if not batch.num_rows:
                continue
            key, content, doc, tie, place = (batch.column(k).to_numpy() for k in range(5))
            known = place & 127 == _DONE
            if known.any():
                yield out(None, doc[known], tie[known], place[known] >> 7, content[known])
            key, content, doc, tie, place = (x[~known] for x in (key, content, doc, tie, place))
            if not len(key):
                continue
            start, count = place >> 7, place & 127
            last = last or (key[0] ^ 1, 0, 0, 0, 0)
            before = [np.concatenate([[x], y[:-1]]) for x, y in zip(last, (key, content, doc, tie, place), strict=True)]
            same = (key == before[0]) & (content == before[1])
            gone = same & ~((doc == before[2]) & (tie == before[3]) & (place == before[4]))
            last = (key[-1], content[-1], doc[-1], tie[-1], place[-1])
            if gone.any():
                yield out(None, *_joined(doc[gone], tie[gone], start[gone], start[gone] + count[gone]))
            new = np.flatnonzero(~same)
            firsts = [x[new] for x in (key, doc, tie, start, start + count)]
            if held is not None:
                firsts = [np.concatenate([[x], y]) for x, y in zip(held, firsts, strict=True)]
            if not len(firsts[0]):
                continue
            k = firsts[0]
            with_before = np.concatenate([[shared], k[1:] == k[:-1]])
            several = with_before.copy()
            several[:-1] |= with_before[1:]
            held, shared = [x[-1] for x in firsts], bool(with_before[-1])
            ready = np.flatnonzero(several[:-1])
            if len(ready):
                yield out(*(x[ready] for x in firsts))
        if held is not None and shared:
            yield out(*(np.array([x]) for x in held))

    dealt = rows.repartition(F.col("key")).sortWithinPartitions("key", "content", "doc", "tie", "place")
    return map_texts(dealt, run, ", ".join(f"{x} long" for x in names))


def _fetched(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted pieces."""
    lists = wanted.groupBy("doc", "tie").agg(F.collect_list(F.struct("key", "a", "b")).alias("parts"))
    found = docs.join(lists.hint("shuffle_hash"), ["doc", "tie"]).withColumn("raw", F.encode("text", "utf-8"))
    part = found.dropDuplicates(["doc", "tie"]).select("doc", "tie", "raw", F.explode("parts").alias("p"))
    return part.select("p.key", "doc", "tie", "p.a", "p.b", F.substring("raw", F.col("p.a").cast("int") + 1, (F.col("p.b") - F.col("p.a")).cast("int") + length - 1).alias("bytes"))


def shard_classes(texts: list[bytes], starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Equal strings among all starts of some pieces, given in order of place.

    Returns for each start the piece it is in, its offset there, whether an equal string starts before it, and the
    start's place in the joined bytes."""
    joined = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    symbols = joined.astype(np.int16) + 2
    size = np.array([len(t) for t in texts]) + 1
    symbols[np.cumsum(size) - 1] = 1
    sa = suffix_array(np.append(symbols, np.int16(0)))[1:]
    shared = permuted_lcp(joined, sa)
    piece = np.repeat(np.arange(len(texts)), starts)
    offset = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
    place = (np.cumsum(size) - size)[piece] + offset
    group = np.cumsum(shared[sa] < length)
    leader = np.full(group[-1] + 1, len(joined))
    valid = np.zeros(len(joined), bool)
    valid[place] = True
    in_order = valid[sa]
    np.minimum.at(leader, group[in_order], sa[in_order])
    of = np.empty(len(joined), np.int64)
    of[sa] = leader[group]
    return piece, offset, of[place] != place, place


def _shard_rows(parts: DataFrame, length: int) -> DataFrame:
    """Removed starts of each shard as ``(key, content, doc, tie, a, b)`` with null hashes; from split shards also each
    class's first start, with the two hashes of its bytes."""
    names = ["key", "content", "doc", "tie", "a", "b"]

    def solve(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows)
        doc, tie, a, b = (t[x].to_numpy() for x in ("doc", "tie", "a", "b"))
        order = np.lexsort((a, tie, doc))
        texts = t["bytes"].take(pa.array(order)).to_pylist()
        doc, tie, a, b = doc[order], tie[order], a[order], b[order]
        piece, offset, later, place = shard_classes(texts, b - a, length)
        p, o = piece[later], offset[later]
        cols = _joined(doc[p], tie[p], a[p] + o, a[p] + o + 1)
        none = pa.nulls(len(cols[0]), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, *(pa.array(x) for x in cols)], names=names)
        if t["split"][0].as_py():
            joined = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
            p, o, at = piece[~later], offset[~later], place[~later]
            ranges = tb.RangeHash(joined)
            keys = [pa.array(ranges(at, at + length, salt).view(np.int64)) for salt in (2, 3)]
            yield pa.RecordBatch.from_arrays([*keys, *(pa.array(x) for x in (doc[p], tie[p], a[p] + o, a[p] + o + 1))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            shard = batch.column("shard").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                if held and held[0].column("shard")[0].as_py() != shard[x]:
                    yield from solve(held)
                    held = []
                if y > x:
                    held.append(batch.slice(x, y - x))
        if held:
            yield from solve(held)

    return map_texts(parts, run, ", ".join(f"{x} long" for x in names))


def repeated_starts(docs: DataFrame, length: int = 100, gram: int = 20, shard_bytes: int = 1 << 19, hot_bytes: int = 1 << 23) -> DataFrame:
    """Ranges ``(doc, tie, a, b)`` of starts (from a, below b) whose ``length`` bytes also start earlier."""
    if not 1 <= gram <= length <= 1 << 17:
        raise ValueError("gram must be from 1 to length, and length at most 131072")
    found = stored(_first_pieces(_piece_rows(docs, length, gram)), "pieces")
    gone = found.filter("key is null").select("doc", "tie", "a", "b")
    wanted = found.filter("key is not null")
    size = F.col("b") - F.col("a") + length
    total = wanted.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    shards = max(1, int(total // shard_bytes))
    hot = wanted.groupBy("key").agg(F.sum(size).alias("bytes")).filter(F.col("bytes") > hot_bytes)
    hot = stored(hot.select("key", F.ceil(F.col("bytes") / hot_bytes).cast("long").alias("splits")), "hot-anchors")
    any_hot = bool(hot.limit(1).count())
    parts = _fetched(docs, wanted, length)
    shard = F.pmod(F.xxhash64("key"), F.lit(shards))
    if any_hot:
        parts = parts.join(hot, "key", "left")
        salt = F.pmod(F.xxhash64("doc", "tie", "a"), F.col("splits"))
        parts = parts.withColumn("shard", F.when(F.col("splits").isNull(), shard).otherwise(-1 - F.pmod(F.xxhash64("key", salt), F.lit(1 << 40)))).withColumn("split", F.col("splits").isNotNull())
    else:
        parts = parts.withColumn("shard", shard).withColumn("split", F.lit(False))
    parts = parts.select("shard", "split", "doc", "tie", "a", "b", "bytes").repartition(max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(shards, 10_000)), "shard").sortWithinPartitions("shard")
    solved = _shard_rows(parts, length)
    if any_hot:
        solved = stored(solved, "shards")
        first = solved.filter("key is not null").select("key", "content", "doc", "tie", F.shiftleft("a", 7).bitwiseOR(F.lit(1)).alias("place"))
        gone = gone.unionByName(_first_pieces(first).filter("key is null").select("doc", "tie", "a", "b"))
        solved = solved.filter("key is null")
    return gone.unionByName(solved.select("doc", "tie", "a", "b"))


def identified(docs: DataFrame, doc: str = "doc", tie: str = "tie") -> DataFrame:
    """``docs`` with the identity ``(doc, tie)`` that the steps use: a long in the order of the ids, the greatest for null
    ids, and a hash of the text, 0 if no id stands twice. Ids that aren't integers get the place of their sorted order."""
    kind, ids = docs.schema["doc_id"].dataType, docs.select("doc_id")
    twice = ids.groupBy("doc_id").count().filter("count > 1").limit(1).count()
    hashed = F.xxhash64("text").bitwiseAND(F.lit(_LAST_ID)) if twice else F.lit(0).cast("long")
    if isinstance(kind, IntegralType):
        return docs.withColumns({doc: F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)), tie: hashed})
    ranks = stored(ids.filter("doc_id is not null").distinct().orderBy("doc_id").select("doc_id", F.monotonically_increasing_id().alias(doc)), "id-ranks")
    found = docs.join(ranks, "doc_id", "left")
    return found.select(*docs.columns, F.coalesce(doc, F.lit(_LAST_ID)).alias(doc), hashed.alias(tie))


def without_repeats(docs: DataFrame, length: int = 100, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and ``spans``, the removed byte ranges."""
    docs = identified(docs.select("doc_id", "text"))
    lists = repeated_starts(docs, length, **options).groupBy("doc", "tie").agg(F.collect_list(F.struct("a", "b")).alias("parts"))
    found = docs.join(lists.hint("shuffle_hash"), ["doc", "tie"], "left").select("doc_id", "text", "parts")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.column_bytes(batch.column("text"))
            rows = []
            for k, parts in enumerate(batch.column("parts").to_pylist()):
                raw = data[offsets[k] : offsets[k + 1]]
                spans: list[list[int]] = []
                for a, b in sorted((p["a"], p["b"] - 1 + length) for p in parts or ()):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                digest, at = hashlib.sha256(), 0
                for a, b in spans:
                    digest.update(raw[at:a].tobytes())
                    at = b
                digest.update(raw[at:].tobytes())
                rows.append((len(raw), sum(b - a for a, b in spans), len(spans), digest.hexdigest(), [{"first": a, "last": b} for a, b in spans]))
            n_bytes, n_removed, n_spans, sha, spans_ = zip(*rows, strict=True) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha, pa.string()), pa.array(spans_, kind)], names=names)

    return map_texts(found, run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<first:long,last:long>>")
