"""Line deduplication: exact copies, and near copies found by a segment-partition edit join.

A line (stripped of white space at its ends, compared as UTF-8 bytes) is removed if an equal line stands earlier, in a
document of smaller id or further up in the same one, or if it is near some earlier line by the thresholds of
``GROWING``, which follow the shorter line: 1 byte edit from 10 bytes, 2 from 20; also 1 word edit (a word replaced, put
in or left out) from 8 words, 2 from 32 and 4 from 64, where they include the byte edits. Thresholds stop at 4 words, as
keys grow with their cube. Empty lines stay; ``min_bytes`` and ``classes`` can be set otherwise.

Near copies: of two lines within t edits, cut into t + 1 even segments, the longer holds some segment of the shorter at
nearly the same place (Li, Deng, Wang and Feng 2011). So each distinct line is indexed under its own segments, and
probes the index of each length that is up to t shorter with the few substrings that the multi-match-aware windows
leave. Only keys that two lines share are kept. Lines that share a key are compared
by length, by counts of their bytes, and by banded bit-parallel edit distance (Hyyrö 2003), many pairs at once. Keys of
more than ``BLOCK`` lines are compared by pairs of blocks, so no task holds all of them; what leaves a task is the lines
to remove, never pairs.

Texts are read again only for the lines that share a key. Defined results: null texts have no lines; a null id comes
after all others; ids may be of any type with an order; rows that repeat id and text are one document; texts that share
an id are ordered by a hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm import textbytes as tb
from weft.llm.repeats import identified
from weft.llm.shared import fresh, map_texts, maybe_in, stored

#: Lines of a key compared in one task, pairs of lines given to one partition, and keys of a line, about.
BLOCK, PAIRS, KEYS = 256, 1 << 20, 32
#: Earlier lines of its group with which a line is compared first.
FEW = 8


class Near(NamedTuple):
    """Lines whose shorter one has ``least`` to ``below - 1`` bytes or words are near within ``distance`` of these."""

    words: bool
    distance: int
    least: int
    below: int = 1 << 40


#: Two byte edits touch four words at most, so longer lines than these need no byte edits beside the last class.
GROWING = [Near(False, 1, 10, 20), Near(False, 2, 20), Near(True, 1, 8, 32), Near(True, 2, 32, 64), Near(True, 4, 64)]
#: Words from which a line is left to the last class: those of its shorter line and of two split ones.
LONG_WORDS = 64 + 2


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, number, first and last byte of each line, white space stripped at its ends."""
    cuts = np.flatnonzero(data == 10)
    row = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, cuts, "right") - 1])
    start = np.concatenate([offsets[:-1], cuts + 1])
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    end = offsets[row + 1]
    inner = np.flatnonzero(row[1:] == row[:-1])
    end[inner] = start[inner + 1] - 1
    solid = np.flatnonzero(data > 32)
    a, b = np.searchsorted(solid, start), np.searchsorted(solid, end)
    full = a < b
    first = np.where(full, solid[np.minimum(a, max(len(solid) - 1, 0))] if len(solid) else start, start)
    last = np.where(full, solid[np.maximum(b, 1) - 1] + 1 if len(solid) else start, first)
    number = np.arange(len(row)) - np.searchsorted(row, row)
    return row, number, first, last


def _segment(length: np.ndarray, k: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the segment ``k`` of lines cut into ``parts``; the last ones take what is over."""
    base, over = length // parts, length % parts
    return k * base + np.maximum(0, k - (parts - over)), base + (k >= parts - over)


def segment_keys(ranges: tb.RangeHash, first: np.ndarray, last: np.ndarray, distance: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Keys, line numbers, and whether they index (rather than probe)."""
    size, parts = last - first, distance + 1
    for shorter in range(distance + 1):
        length = size - shorter
        for k in range(parts):
            start, width = _segment(length, k, parts)
            for shift in range(max(-k, shorter - (distance - k)), min(k, shorter + distance - k) + 1):
                at = np.flatnonzero((length >= least) & (start + shift >= 0) & (start + shift + width <= size))
                a = first[at] + start[at] + shift
                own = tb.mix((length[at] * parts + k).astype(tb.U64), 2)
                yield tb.mix(ranges(a, a + width[at], 1) ^ own, 3), at, not shorter and not shift


def line_words(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of ascending lines, runs of bytes that aren't white space, and each line's bounds in them."""
    start, end = tb.spans(data > 32, np.concatenate([first, last]))
    return tb.RangeHash(data)(start, end, 5), np.searchsorted(start, first), np.searchsorted(start, last)


def class_keys(data: np.ndarray, first: np.ndarray, last: np.ndarray, classes: list[Near]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, whose low bits are the number of the class, line numbers, and whether each indexes. Lines ascend."""
    words, a, b = line_words(data, first, last)
    in_bytes, in_words = tb.RangeHash(data), tb.RangeHash(words)
    n, split = b - a, any(c.words and c.below > 1 << 32 for c in classes)
    for number, c in enumerate(classes):
        size = n if c.words else last - first
        fits = (size >= c.least) & (size < c.below + c.distance)
        if split and not c.words:
            fits &= n < LONG_WORDS
        at = np.flatnonzero(fits)
        low, high = (a[at], b[at]) if c.words else (first[at], last[at])
        for key, which, index in segment_keys(in_words if c.words else in_bytes, low, high, c.distance, c.least):
            yield (tb.mix(key, 20 + number) & ~tb.U64(15)) | tb.U64(number), at[which], (size[at[which]] < c.below) & index


def _hashed(ranges: tb.RangeHash, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ranges(first, last, 0).view(np.int64), ranges(first, last, 9).view(np.int64)


def occurrences(docs: DataFrame, min_bytes: int) -> DataFrame:
    """``(h1, h2, doc, tie, line)`` of each line that may be removed."""
    names = ["h1", "h2", "doc", "tie", "line"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, data, offsets in tb.slices(whole):
                row, number, first, last = lines_of(data, offsets)
                at = np.flatnonzero(last - first >= min_bytes)
                h1, h2 = _hashed(tb.RangeHash(data), first[at], last[at])
                ids, ties = batch.column("doc").to_numpy(), batch.column("tie").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h1, h2, ids[row[at]], ties[row[at]], number[at])], names=names)

    return map_texts(docs.select("doc", "tie", "text"), run, ", ".join(f"{x} long" for x in names))


def _key_rows(docs: DataFrame, classes: list[Near]) -> DataFrame:
    """``(key, line)``, the lowest bit of the line's hash telling whether the key indexes it. Repeats within a slice of
    a task go before the shuffle."""
    least = min(c.least for c in classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for _, data, offsets in tb.slices(whole, most=1 << 20):
                _, _, first, last = lines_of(data, offsets)
                at = np.flatnonzero(last - first >= least)
                h = tb.RangeHash(data)(first[at], last[at], 0)
                once = np.sort(np.unique(h, return_index=True)[1])
                h, at = h[once], at[once]
                for key, which, index in class_keys(data, first[at], last[at], classes):
                    line = (h[which] & ~tb.U64(1)) | index.astype(tb.U64)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(line.view(np.int64))], names=["key", "line"])

    return map_texts(docs.select("text"), run, "key long, line long")


class _Sharers:
    """Gathers ``(key, line)`` rows and gives back those of keys that several lines have. Of each key one row is held."""

    def __init__(self) -> None:
        self.key, self.line, self.shared = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, key: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``key`` and ``line`` whose key has another line, and rows held so far whose key has one now."""
        key, line = np.concatenate([self.key, key]), np.concatenate([self.line, line])
        shared = np.concatenate([self.shared, np.zeros(len(line) - len(self.shared), bool)])
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        at = order[several]
        at = at[np.lexsort((~shared[at], line[at], key[at]))]
        new = np.ones(len(at), bool)
        new[1:] = (key[at[1:]] != key[at[:-1]]) | (line[at[1:]] != line[at[:-1]])
        at = at[new]
        begin = np.flatnonzero(np.concatenate([[True], key[at[1:]] != key[at[:-1]]])) if len(at) else at
        count = np.diff(np.append(begin, len(at)))
        known = np.logical_or.reduceat(shared[at], begin) if len(at) else np.empty(0, bool)
        good = known | (count > 1)
        out = at[np.repeat(good, count) & ~shared[at]]
        alone = order[~several]
        rest = at[begin]
        self.key, self.line = np.concatenate([key[alone], key[rest]]), np.concatenate([line[alone], line[rest]])
        self.shared = np.concatenate([shared[alone], good])
        return key[out], line[out]


def _shared_keys(rows: DataFrame, partitions: int, held: int = 1 << 20) -> DataFrame:
    """Rows of keys that at least two lines have; a row may come twice. A task holds one row of each of its keys and
    ``held`` others, so a key of any number of lines needs no more room."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, waiting, n = _Sharers(), [], 0
        for batch in batches:
            waiting.append([batch.column(k).to_numpy() for k in range(2)])
            n += batch.num_rows
            if n >= held:
                yield from flush(found, waiting)
                waiting, n = [], 0
        yield from flush(found, waiting)

    def flush(found: _Sharers, waiting: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if waiting:
            key, line = found.add(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
            if len(key):
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(line)], names=["key", "line"])

    return map_texts(rows.repartition(partitions, "key"), run, "key long, line long")


def within_distance(symbols: np.ndarray, first: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, distance: int, lanes: int = 8192, cells: int = 1 << 21) -> np.ndarray:
    """Whether lines ``a`` and ``b`` are within ``distance`` edits, for many pairs at once. Line k is the ``size[k]`` non-negative
    integers of ``symbols`` from ``first[k]``.

    Bit o of a column's words stands for the row o - distance below the diagonal. The distance is the difference of
    the lengths and one for each step of the final diagonal that doesn't keep its value; pairs beyond it are dropped on
    the way."""
    out = np.zeros(len(a), bool)
    order = np.argsort(size[b], kind="stable")
    one, full = np.uint32(1), np.uint32((1 << (2 * distance + 1)) - 1)
    at = 0
    while at < len(order):
        many = lanes
        while many > 1 and int(size[b[order[min(at + many, len(order)) - 1]]] + distance) * many > cells:
            many //= 2
        chunk, at = order[at : at + many], at + many
        m, n = size[a[chunk]], size[b[chunk]]
        chunk = chunk[np.abs(m - n) <= distance]
        if not len(chunk):
            continue
        m, n = size[a[chunk]], size[b[chunk]]
        step = np.arange(int(max(m.max(), n.max())))[:, None]
        cut = lambda of, most: np.where(step < most, symbols[np.minimum(first[of] + step, len(symbols) - 1)], -1)
        rows = np.full((len(step) + 2 * distance + 1, len(chunk)), -1, symbols.dtype)
        rows[distance : distance + len(step)] = cut(a[chunk], m)
        cols = cut(b[chunk], n)
        cols[step >= n] = -2
        vp = np.full(len(chunk), full & ~np.uint32((1 << distance) - 1), np.uint32)
        vn = np.zeros(len(chunk), np.uint32)
        last = (distance + m - n).astype(np.uint32)
        score = np.abs(m - n)
        for j in range(len(step)):
            pm = np.zeros(len(chunk), np.uint32)
            for o in range(2 * distance + 1):
                pm |= (rows[j + o] == cols[j]).astype(np.uint32) << np.uint32(o)
            d0 = ((((pm & vp) + vp) ^ vp) | pm | vn) & full
            hp, hn = (vn | ~(d0 | vp)) & full, d0 & vp
            down = d0 >> one
            vp, vn = (hn | ~(down | hp)) & full, down & hp
            live = (j < n) & (j + 1 + m - n >= 1)
            score = score + (live & (((d0 >> last) & one) == 0))
            if j % 16 == 15:
                left = np.flatnonzero(score <= distance)
                if not len(left):
                    chunk = chunk[:0]
                    break
                if 2 * len(left) < len(chunk):
                    chunk, m, n, vp, vn, last, score = (x[left] for x in (chunk, m, n, vp, vn, last, score))
                    rows, cols = rows[:, left], cols[:, left]
        out[chunk] = (score <= distance) if len(chunk) else False
    return out


def _pairs(rows: np.ndarray, begin: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of each of ``rows`` and the earlier rows of its group, which starts at ``begin``, ``low`` + 1 to ``high`` back."""
    before = np.clip(np.minimum(rows - begin, high) - low, 0, None)
    b = np.repeat(rows, before)
    return b - low - 1 - (np.arange(len(b)) - np.repeat(np.cumsum(before) - before, before)), b


def near_rows(symbols: np.ndarray, first: np.ndarray, size: np.ndarray, begin: np.ndarray, side: np.ndarray, distance: int, most: int = 1 << 18) -> np.ndarray:
    """Which lines are near an earlier one of their group. Groups follow each other; ``begin`` is where a line's starts.
    Groups that have lines of two sides are compared across them only. ``most`` pairs are held at a time. A line that is near
    one of the few before it is compared with no more, so a group of near copies costs little more than its size."""
    out = np.zeros(len(size), bool)
    counts = np.zeros((len(size), 64), np.int16)
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + first[row]
    found = np.bincount(row * 64 + (symbols[place] & 63), minlength=64 * len(size)).reshape(-1, 64)
    np.minimum(found, 1 << 14, out=found)
    counts[:] = found
    starts = np.unique(begin)
    two = np.repeat(np.maximum.reduceat(side, starts) > np.minimum.reduceat(side, starts), np.diff(np.append(starts, len(size))))
    for low, high in ((0, FEW), (FEW, len(size))):
        rows = np.flatnonzero(~out & (np.arange(len(size)) - begin > low))
        total, at = np.cumsum(np.minimum(rows - begin[rows], high) - low), 0
        while at < len(rows):
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
            a, b = _pairs(rows[at:stop], begin[rows[at:stop]], low, high)
            good = np.flatnonzero((np.abs(size[a] - size[b]) <= distance) & (~two[b] | (side[a] != side[b])))
            a, b = a[good], b[good]
            good = np.concatenate([np.abs(counts[a[k : k + 8192]] - counts[b[k : k + 8192]]).sum(1, dtype=np.int64) <= 2 * distance for k in range(0, len(a), 8192)] or [np.zeros(0, bool)])
            a, b = a[good], b[good]
            if len(a):
                out[b[within_distance(symbols, first, size, a, b, distance)]] = True
            at = stop
    return out


def _later_copies(rows: DataFrame, classes: list[Near], held_rows: int = 1 << 14, held_bytes: int = 1 << 23) -> DataFrame:
    """``(h1, h2)`` of lines that are near an earlier line of their task by its class. Many tasks are compared at once;
    ``rows`` are sorted by task."""

    def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
        if not t.num_rows:
            return
        t = t.combine_chunks()
        task, doc, tie, line, side, kind = (t[c].to_numpy() for c in ("task", "doc", "tie", "line", "side", "class"))
        for number in np.unique(kind):
            own = np.flatnonzero(kind == number)
            own = own[np.lexsort((line[own], tie[own], doc[own], task[own]))]
            data, offsets = tb.column_bytes(t["bytes"].take(pa.array(own)).combine_chunks(), pa.large_binary())
            start = np.flatnonzero(np.concatenate([[True], task[own][1:] != task[own][:-1]]))
            begin = np.repeat(start, np.diff(np.append(start, len(own))))
            near_by = classes[number]
            if near_by.words:
                words, a, b = line_words(data, offsets[:-1], offsets[1:])
                symbols = np.unique(words, return_inverse=True)[1].astype(np.int32)
            else:
                symbols, a, b = data.astype(np.int16), offsets[:-1], offsets[1:]
            gone = own[near_rows(symbols, a, b - a, begin, side[own], near_by.distance)] if len(symbols) else own[:0]
            if len(gone):
                yield pa.RecordBatch.from_arrays([pa.array(t[c].to_numpy()[gone]) for c in ("h1", "h2")], names=["h1", "h2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(x.num_rows for x in held) < held_rows and sum(x.nbytes for x in held) < held_bytes:
                continue
            t = pa.Table.from_batches(held)
            task = t["task"].to_numpy()
            cut = int(np.flatnonzero(task == task[-1])[0])
            yield from solve(t.slice(0, cut))
            held = t.slice(cut).to_batches()
        if held:
            yield from solve(pa.Table.from_batches(held))

    return map_texts(rows, run, "h1 long, h2 long")


def _line_bytes(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``members(h1, h2, doc, tie, line)`` with the bytes of their lines."""
    lists = members.groupBy("doc", "tie").agg(F.collect_list(F.struct("h1", "h2", "line")).alias("wanted"))
    found = maybe_in(docs, members, "doc").join(lists.hint("shuffle_hash"), ["doc", "tie"]).dropDuplicates(["doc", "tie"])
    names = ["h1", "h2", "doc", "tie", "line", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, data, offsets in tb.slices(whole):
                row, _, first, last = lines_of(data, offsets)
                begin = np.searchsorted(row, np.arange(batch.num_rows))
                out = []
                for k, (doc, tie, wanted) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc", "tie", "wanted")), strict=True)):
                    for x in wanted:
                        at = begin[k] + x["line"]
                        out.append((x["h1"], x["h2"], doc, tie, x["line"], data[first[at] : last[at]].tobytes()))
                cols = list(zip(*out, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.binary())], names=names)

    return map_texts(found.select("doc", "tie", "text", "wanted"), run, "h1 long, h2 long, doc long, tie long, line long, bytes binary")


def near_copies(docs: DataFrame, firsts: DataFrame, classes: list[Near]) -> DataFrame:
    """``(h1, h2)`` of distinct lines that are near copies of an earlier one. ``firsts``: (h1, h2, doc, tie, line)."""
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + firsts.count() * KEYS // (1 << 19))
    keys = stored(_shared_keys(_key_rows(docs, classes), partitions).hint("rebalance"), "line-keys")
    low = F.col("h1").bitwiseAND(F.lit(-2))
    wanted = keys.select(F.col("line").bitwiseAND(F.lit(-2)).alias("low")).distinct()
    members = stored(firsts.withColumn("low", low).join(wanted, "low").select("h1", "h2", "doc", "tie", "line").hint("rebalance"), "line-members")
    lines = stored(_line_bytes(docs, members).hint("rebalance"), "line-bytes")
    size = F.count("*")
    blocks = F.ceil(size / BLOCK).cast("int")
    sizes = keys.groupBy("key").agg(blocks.alias("blocks"), (size * F.least(size, F.lit(2 * BLOCK))).alias("pairs"), F.max(F.col("line").bitwiseAND(F.lit(1))).alias("indexed"))
    sizes = stored(sizes.filter("indexed = 1").drop("indexed"), "line-key-sizes")
    tasks = 1 + int((sizes.agg(F.sum("pairs")).first()[0] or 0) // PAIRS)
    each = keys.join(sizes.drop("pairs"), "key").select("key", "blocks", F.col("line").bitwiseAND(F.lit(-2)).alias("low")).distinct()
    rows = each.join(lines.withColumn("low", low), "low")
    block = F.pmod(F.xxhash64("h1", "h2"), F.col("blocks")).cast("int")
    rows = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    task = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    rows = rows.select(task.alias("task"), F.col("key").bitwiseAND(F.lit(15)).alias("class"), "h1", "h2", "doc", "tie", "line", F.col("block").__gt__(F.col("other")).cast("long").alias("side"), "bytes")
    return _later_copies(rows.repartition(tasks, "task").sortWithinPartitions("task"), classes).distinct()


def removed_lines(docs: DataFrame, min_bytes: int = 1, classes: list[Near] | None = None) -> DataFrame:
    """``(doc, tie, lines)``: the ascending numbers of each document's removed lines; documents without any are left
    out. ``docs`` has the identity columns of :func:`weft.llm.repeats.identified`. ``classes`` are :data:`GROWING` if not
    given."""
    seen = stored(occurrences(docs, min_bytes), "lines")
    firsts = stored(seen.groupBy("h1", "h2").agg(F.min(F.struct("doc", "tie", "line")).alias("f")).select("h1", "h2", "f.doc", "f.tie", "f.line"), "first-lines")
    near = near_copies(docs, firsts, GROWING if classes is None else classes).withColumn("near", F.lit(True))
    known = stored(firsts.join(near, ["h1", "h2"], "left").select("h1", "h2", F.struct("doc", "tie", "line").alias("first"), "near"), "known-lines")
    gone = seen.join(known, ["h1", "h2"]).filter(F.col("near").isNotNull() | (F.struct("doc", "tie", "line") != F.col("first")))
    return gone.groupBy("doc", "tie").agg(F.sort_array(F.collect_set(F.col("line").cast("int"))).alias("lines"))


def line_report(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines, n_removed and removed_lines, their numbers from 0, comma-joined."""
    docs = identified(docs.select("doc_id", "text"))
    n_lines = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0))
    own = docs.select("doc_id", "doc", "tie", n_lines.cast("long").alias("n_lines"))
    found = own.join(removed_lines(docs, **options), ["doc", "tie"], "left")
    return found.select("doc_id", "n_lines", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.array_join(F.col("lines").cast("array<string>"), ","), F.lit("")).alias("removed_lines"))


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the removed lines; documents of which nothing is left go. ``n_chars`` follows, if there. Other
    columns keep their values, whatever their names."""
    doc, tie, lines = (fresh(docs.columns, c) for c in ("doc", "tie", "lines"))
    gone = removed_lines(identified(docs.select("doc_id", "text")), **options).withColumnsRenamed({"doc": doc, "tie": tie, "lines": lines})
    found = identified(docs, doc, tie).join(gone.hint("shuffle_hash"), [doc, tie], "left")
    every = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), lines)
    text = F.when(F.col(lines).isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda k: F.get(every, k)), "\n"))
    out = found.withColumn("text", text).filter(F.col(lines).isNull() | (F.trim(F.translate("text", "\n\r\t", "   ")) != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(lines).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)
