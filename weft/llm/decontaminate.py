"""Benchmark decontamination with a generalised suffix automaton.

The automaton (Blumer et al. 1985) recognises every run of consecutive words of every benchmark item. Document words
are streamed through it while the length of the longest match that ends at each word is tracked. A document word is
*hit* if it lies in an occurrence of a window: ``window`` consecutive words of an item, or all words of a shorter one.

Stretches of a document in which some pair of neighbouring words follows in no item can't hold a window, so they are
skipped before the automaton runs. That test uses hashes; the automaton compares words themselves.

Items of at most ``shard_words`` words in all make one automaton that every worker gets. Larger benchmarks are dealt into
shards of about as many words, whose automata are built by the tasks that use them; stretches of documents are sent to
the shards that may hold their windows, so neither the driver nor a worker ever holds more than one automaton.

Defined results: null texts, empty texts and texts without words have no words and no hits; null or wordless items
match nothing; items with a null id take part in hits but are not listed; repeated items and repeated documents are
treated row by row; other columns of either table are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm import textbytes as tb
from weft.llm.shared import fresh, map_texts, maybe_marked, stored

#: A word, before A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SPANS = "n_words long, spans array<struct<first:int,last:int,first_byte:int,last_byte:int>>, item_ids array<string>"


class SuffixAutomaton:
    """Suffix automaton of several word sequences, with the items in which each window occurs."""

    def __init__(self, items: list[tuple[str | None, list[str]]], window: int):
        self.window = window
        self.follow: list[dict[str, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.whole: dict[int, list[tuple[int, str | None]]] = {}
        self.holders: dict[int, set[str | None]] = {}
        for name, words in items:
            state = 0
            for k, word in enumerate(words):
                state = self.follow[state][word]
                if k + 1 >= window:
                    state = self.cut(state, window)
                    self.holders.setdefault(state, set()).add(name)
            if 0 < len(words) < window:
                self.whole.setdefault(self.cut(state, len(words)), []).append((len(words), name))

    def _clone(self, state: int, length: int) -> int:
        self.follow.append(dict(self.follow[state]))
        self.link.append(self.link[state])
        self.length.append(length)
        return len(self.length) - 1

    def _redirect(self, state: int, word: str, old: int, new: int) -> None:
        while state >= 0 and self.follow[state].get(word) == old:
            self.follow[state][word] = new
            state = self.link[state]

    def _extend(self, last: int, word: str) -> int:
        """Append ``word`` after the sequence that ended in ``last``; sequences may share what they have in common."""
        goal = self.length[last] + 1
        there = self.follow[last].get(word)
        if there is not None:
            if self.length[there] == goal:
                return there
            copy = self._clone(there, goal)
            self.link[there] = copy
            self._redirect(last, word, there, copy)
            return copy
        new = len(self.length)
        self.follow.append({})
        self.link.append(0)
        self.length.append(goal)
        state = last
        while state >= 0 and word not in self.follow[state]:
            self.follow[state][word] = new
            state = self.link[state]
        if state >= 0:
            there = self.follow[state][word]
            if self.length[there] != self.length[state] + 1:
                copy = self._clone(there, self.length[state] + 1)
                self.link[there] = copy
                self._redirect(state, word, there, copy)
                there = copy
            self.link[new] = there
        return new

    def cut(self, state: int, most: int) -> int:
        """The state of the last ``most`` words of what ``state`` stands for."""
        while self.length[self.link[state]] >= most:
            state = self.link[state]
        return state

    def stream(self, words: list[str]) -> Iterator[tuple[int, int, set[str | None]]]:
        """For each end of a window in ``words``: its end, its length in words, and the items that hold it."""
        state = matched = 0
        for k, word in enumerate(words):
            while state and word not in self.follow[state]:
                state = self.link[state]
                matched = self.length[state]
            if word not in self.follow[state]:
                continue
            state, matched = self.follow[state][word], matched + 1
            low = state
            if matched >= self.window:
                low = self.cut(state, self.window)
                yield k + 1, self.window, self.holders[low]
            while self.whole and low > 0:
                for length, name in self.whole.get(low, ()):
                    if length <= matched:
                        yield k + 1, length, {name}
                low = self.link[low]


def _pairs(h: np.ndarray) -> np.ndarray:
    return tb.mix(h[:-1], 3) + h[1:]


class _Filter:
    """Finds the stretches of words that may hold a window of ``least`` words or more. ``marks`` tells of hashes of words
    (if ``least`` is 1) or of pairs of them whether an item may have them."""

    def __init__(self, least: int, marks: Callable[[np.ndarray], np.ndarray]):
        self.least, self.marks = least, marks

    @classmethod
    def of_items(cls, items: list[tuple[str | None, list[str]]], window: int) -> _Filter:
        least = min((min(len(words), window) for _, words in items if words), default=window)
        w = tb.words_of(*tb.column_bytes(pa.array([" ".join(words) for _, words in items], pa.large_string())))
        known = _sieve_hashes(w, least)
        return cls(least, tb.HashTable(known).marks if len(known) else lambda h: np.zeros(len(h), bool))

    @classmethod
    def of_bitmap(cls, bits: np.ndarray, size: int, least: int) -> _Filter:
        def marks(h: np.ndarray) -> np.ndarray:
            place = h >> tb.U64(64 - size)
            return (bits[(place >> tb.U64(6)).astype(np.int64)] >> (place & tb.U64(63))) & tb.U64(1) == 1

        return cls(least, marks)

    def stretches(self, w: tb.Words) -> tuple[np.ndarray, np.ndarray]:
        if not len(w.hash):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        found = self.marks(w.hash if self.least == 1 else _pairs(w.hash))
        if self.least == 1:
            return tb.spans(found, w.bounds)
        cut = w.bounds[1:-1]
        found[cut[(cut > 0) & (cut < len(w.hash))] - 1] = False
        first, last = tb.spans(found, np.array([0, len(found)]))
        keep = last - first >= self.least - 1
        return first[keep], last[keep] + 1


def _sieve_hashes(w: tb.Words, least: int) -> np.ndarray:
    """Hashes of the words of each text, or of its pairs of neighbouring words."""
    if least == 1 or not len(w.hash):
        return w.hash
    inner = np.ones(len(w.hash) - 1, bool)
    cut = w.bounds[1:-1]
    inner[cut[(cut > 0) & (cut < len(w.hash))] - 1] = False
    return _pairs(w.hash)[inner]


def anchors(h: np.ndarray, lengths: list[int]) -> np.ndarray:
    """Of each run of so many words, the least hash among its pairs of neighbours: equal windows have equal anchors."""
    pairs = tb.mix(_pairs(h), 21) if len(h) > 1 else h[:0]
    found = [tb.mix(h, 22) if n == 1 else sliding_window_view(pairs, n - 1).min(1) for n in lengths if len(h) >= n]
    return np.unique(np.concatenate(found)) if found else h[:0]


def _merged(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    out: list[tuple[int, int, int, int]] = []
    for span in sorted(found):
        if out and span[0] < out[-1][1]:
            if span[1] > out[-1][1]:
                out[-1] = (out[-1][0], span[1], out[-1][2], span[3])
        else:
            out.append(span)
    return out


_SPAN = pa.struct([(x, pa.int32()) for x in ("first", "last", "first_byte", "last_byte")])


def _spans_of(automaton: SuffixAutomaton, words: list[str], base: int, start: np.ndarray, end: np.ndarray) -> tuple[list[tuple[int, int, int, int]], set[str | None]]:
    """Hit spans of a stretch whose first word is the text's word ``base``, and the items that hit it."""
    spans: list[tuple[int, int, int, int]] = []
    held: set[str | None] = set()
    for stop, length, names in automaton.stream(words):
        k = stop - length
        span = (base + k, base + stop, int(start[k]), int(end[stop - 1]))
        if spans and spans[-1][0] <= span[0] <= spans[-1][1] <= span[1]:
            spans[-1] = (spans[-1][0], span[1], spans[-1][2], span[3])
        else:
            spans.append(span)
        held |= names
    return spans, held


def _with_one_automaton(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """For items of a bounded number of words: their automaton goes to every worker."""
    known = []
    for name, text in items.toLocalIterator():
        w = tb.words_of(*tb.column_bytes(pa.array([text], pa.large_string())))
        known.append((name, [w.text(k) for k in range(len(w.start))]))
    shared = docs.sparkSession.sparkContext.broadcast((SuffixAutomaton(known, window), [x for x in known if x[1]]))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = shared.value
        sieve = _Filter.of_items(known, window)
        for whole in batches:
            for batch, data, offsets in tb.slices(whole):
                w = tb.words_of(data, offsets)
                found: list[list[tuple[int, int, int, int]]] = [[] for _ in range(batch.num_rows)]
                held: list[set[str | None]] = [set() for _ in range(batch.num_rows)]
                first, last = sieve.stretches(w)
                rows = np.searchsorted(w.bounds, first, "right") - 1
                for row, a, b in zip(rows.tolist(), first.tolist(), last.tolist(), strict=True):
                    words = [w.text(k) for k in range(a, b)]
                    spans, names_ = _spans_of(automaton, words, a - int(w.bounds[row]), w.start[a:b] - offsets[row], w.end[a:b] - offsets[row])
                    found[row] += spans
                    held[row] |= names_
                yield _reported(batch, names, np.diff(w.bounds), found, held)

    return map_texts(docs, run, f"{_fields(docs)}, {SPANS}")


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _reported(batch: pa.RecordBatch, names: list[str], n_words: np.ndarray, spans: list, held: list) -> pa.RecordBatch:
    merged = [[dict(zip(("first", "last", "first_byte", "last_byte"), s, strict=True)) for s in _merged(x)] for x in spans]
    columns = [pa.array(n_words, pa.int64()), pa.array(merged, pa.list_(_SPAN)), pa.array([sorted(x - {None}) for x in held], pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *columns], names=[*names, "n_words", "spans", "item_ids"])


_STRETCH = "k1 long, k2 long, base int, words string, start array<int>, end array<int>, anchors array<long>"


def _item_parts(items: DataFrame, window: int, part_words: int) -> DataFrame:
    """``(name, words, n, anchors, sieve)``: items cut into parts that share ``window`` - 1 words, so each window of an item
    lies in some part; ``n`` is the length of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist(), strict=True):
                w = tb.words_of(*tb.column_bytes(pa.array([text], pa.large_string())))
                words = [w.text(k) for k in range(len(w.start))]
                n = min(len(words), window)
                for a in range(0, max(len(words) - window + 1, 1) if words else 0, part_words):
                    h = w.hash[a : a + part_words + window - 1]
                    out.append((name, " ".join(words[a : a + len(h)]), n, anchors(h, [n]).view(np.int64), h.view(np.int64)))
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.list_(pa.int64())), pa.array(cols[4], pa.list_(pa.int64()))], names=["name", "words", "n", "anchors", "hashes"])

    return map_texts(items, run, "name string, words string, n int, anchors array<long>, hashes array<long>")


def _bitmap(parts: DataFrame, size: int, least: int) -> np.ndarray:
    """Bits of the sieve hashes of all items, ``2 ** size`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty(0, tb.U64)]
            for x in batch.column("hashes").to_pylist():
                h = np.array(x, np.int64).view(tb.U64)
                found.append(h if least == 1 else _pairs(h) if len(h) > 1 else h[:0])
            place = np.unique(np.concatenate(found) >> tb.U64(64 - size))
            slot, begin = np.unique(place >> tb.U64(6), return_index=True)
            bits = np.bitwise_or.reduceat(tb.U64(1) << (place & tb.U64(63)), begin) if len(place) else place
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64)), pa.array(bits.view(np.int64))], names=["slot", "bits"])

    rows = map_texts(parts.select("hashes"), run, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (size - 6), tb.U64)
    out[rows["slot"].to_numpy()] = rows["bits"].to_numpy().view(tb.U64)
    return out


def _stretch_rows(docs: DataFrame, bits: np.ndarray, size: int, least: int, lengths: list[int]) -> DataFrame:
    """Stretches of ``docs(k1, k2, text)`` that the bitmap lets through, with their words, places and anchors."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    ints = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = _Filter.of_bitmap(shared.value, size, least)
        for whole in batches:
            for batch, data, offsets in tb.slices(whole):
                w = tb.words_of(data, offsets)
                first, last = sieve.stretches(w)
                rows = np.searchsorted(w.bounds, first, "right") - 1
                out = []
                for row, a, b in zip(rows.tolist(), first.tolist(), last.tolist(), strict=True):
                    words = " ".join(w.text(k) for k in range(a, b))
                    out.append((a - int(w.bounds[row]), words, (w.start[a:b] - offsets[row]).tolist(), (w.end[a:b] - offsets[row]).tolist(), anchors(w.hash[a:b], lengths).view(np.int64)))
                cols = list(zip(*out, strict=True)) or [()] * 5
                keys = [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("k1", "k2")]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), pa.array(cols[2], ints), pa.array(cols[3], ints), pa.array(cols[4], pa.list_(pa.int64()))], names=["k1", "k2", "base", "words", "start", "end", "anchors"])

    return map_texts(docs, run, _STRETCH)


def _solved(rows: DataFrame, window: int) -> DataFrame:
    """``(k1, k2, spans, names)`` of stretches. ``rows`` are sorted by task; the items of a task come before its stretches,
    so a worker holds one automaton at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, known, automaton = None, [], None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["task"] != task:
                    task, known, automaton = r["task"], [], None
                if r["base"] is None:
                    known.append((r["name"], r["words"].split(" ")))
                    continue
                automaton = automaton or SuffixAutomaton(known, window)
                spans, held = _spans_of(automaton, r["words"].split(" "), r["base"], r["start"], r["end"])
                if spans:
                    out.append((r["k1"], r["k2"], [dict(zip(("first", "last", "first_byte", "last_byte"), s, strict=True)) for s in spans], sorted(held - {None})))
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(_SPAN)), pa.array(cols[3], pa.list_(pa.string()))], names=["k1", "k2", "spans", "names"])

    return map_texts(rows, run, "k1 long, k2 long, spans array<struct<first:int,last:int,first_byte:int,last_byte:int>>, names array<string>")


def _with_dealt_automata(docs: DataFrame, items: DataFrame, window: int, shard_words: int, n_words: int, task_bytes: int = 1 << 25) -> DataFrame:
    """For items of any number of words.

    Items are dealt into shards by hash. Stretches of documents pass a bitmap of bounded size and go to the shards that
    hold one of their anchors, those of a crowded shard to several tasks; each task builds the automaton of its shard.
    Texts are known by 128 bits of hash, and only those with hits are joined to their documents."""
    parts = stored(_item_parts(items, window, max(window, shard_words // 4)), "item-parts")
    lengths = sorted(r["n"] for r in parts.select("n").distinct().collect())
    if not lengths:
        return _with_one_automaton(docs, items, window)
    size = min(28, max(20, math.ceil(math.log2(16 * n_words))))
    shard = F.pmod(F.xxhash64("name", "words"), F.lit(-(-n_words // shard_words))).alias("shard")
    k1, k2, spans = (fresh(docs.columns, c) for c in ("k1", "k2", "spans"))
    keyed = docs.withColumns({k1: F.xxhash64("text"), k2: F.xxhash64("text", F.lit(1))})
    rows = _stretch_rows(keyed.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), "text"), _bitmap(parts, size, lengths[0]), size, lengths[0], lengths)
    stretches = stored(rows.dropDuplicates(["k1", "k2", "base"]), "stretches")
    routes = stored(parts.select(shard, F.explode("anchors").alias("anchor")).distinct(), "routes")
    wanted = stored(stretches.select("k1", "k2", "base", F.explode("anchors").alias("anchor")).join(routes, "anchor").select("k1", "k2", "base", "shard").distinct(), "routed")
    routed = stored(stretches.drop("anchors").join(wanted, ["k1", "k2", "base"]), "routed-stretches")
    splits = stored(routed.groupBy("shard").agg(F.ceil(F.sum(F.length("words") * 4) / task_bytes).cast("int").alias("splits")), "splits")
    held = parts.select(shard, "name", F.col("words")).join(splits, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
    task = F.xxhash64("shard", "salt").alias("task")
    none = lambda kind: F.lit(None).cast(kind)
    held = held.select(task, none("long").alias("k1"), none("long").alias("k2"), none("int").alias("base"), "words", none("array<int>").alias("start"), none("array<int>").alias("end"), "name")
    queue = routed.join(splits, "shard").withColumn("salt", F.pmod(F.xxhash64("k1", "base"), F.col("splits")).cast("int"))
    queue = queue.select(task, "k1", "k2", "base", "words", "start", "end", none("string").alias("name"))
    found = _solved(held.unionByName(queue).repartition("task").sortWithinPartitions("task", F.col("base").asc_nulls_first()), window)
    hits = stored(found.groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("names")).alias("names")), "hits")
    held_names = fresh(docs.columns, "names")
    hits = hits.withColumnsRenamed({"k1": k1, "k2": k2, "spans": spans, "names": held_names})
    may = fresh(keyed.columns, "may")
    marked = maybe_marked(keyed, hits, k1, may)
    empty = {c: none(hits.schema[c].dataType.simpleString()) for c in (spans, held_names)}
    each = marked.filter(~F.col(may)).withColumns(empty).unionByName(marked.filter(may).join(hits.hint("shuffle_hash"), [k1, k2], "left"))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, data, offsets in tb.slices(whole):
                n = np.diff(tb.words_of(data, offsets).bounds)
                found = [[tuple(s.values()) for s in x or ()] for x in batch.column(spans).to_pylist()]
                yield _reported(batch, names, n, found, [set(x or ()) for x in batch.column(held_names).to_pylist()])

    return map_texts(each.select(*names, spans, held_names), run, f"{_fields(docs)}, {SPANS}")


def match_spans(docs: DataFrame, items: DataFrame, window: int = 10, shard_words: int = 200_000, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """All columns of ``docs`` and, for each row, ``n_words``, the hit ``spans`` (word and byte bounds) and ``item_ids``.

    Columns of ``docs`` that bear one of these three names are replaced.
    """
    docs = docs.drop("n_words", "spans", "item_ids")
    items = items.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).alias("text")).distinct()
    n_words = items.agg(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] or 0
    if n_words <= shard_words:
        return _with_one_automaton(docs, items, window)
    return _with_dealt_automata(docs, items, window, shard_words, n_words)


def hit_words(spans: str = "spans") -> F.Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"])


def remove_spans(docs: DataFrame, items: DataFrame, window: int = 10, min_span: int = 10, max_coverage: float = 0.5, **options) -> DataFrame:
    """``docs`` without contaminated text: hit spans of ``min_span`` words or more are cut out, and documents of whose
    words more than ``max_coverage`` are hit are removed. Rows without hits, null texts among them, stay as they are.
    Repeated rows stay repeated; ``n_chars``, where there is one, follows the new text."""
    columns = docs.columns
    aside = {c: f"_own_{c}" for c in ("n_words", "spans", "item_ids") if c in columns}
    found = match_spans(docs.withColumnsRenamed(aside), items, window, **options)
    kept = found.filter(hit_words() <= F.col("n_words") * max_coverage)
    long = F.filter("spans", lambda s: s["last"] - s["first"] >= min_span)
    raw = F.encode("text", "utf-8")
    cut = F.concat_ws(
        "",
        F.transform(long, lambda s, k: F.decode(F.substring(raw, F.when(k == 0, 1).otherwise(F.get(long, k - 1)["last_byte"] + 1), s["first_byte"] - F.when(k == 0, 0).otherwise(F.get(long, k - 1)["last_byte"])), "utf-8")),
        F.decode(F.substring(raw, F.element_at(long, -1)["last_byte"] + 1, F.length(raw)), "utf-8"),
    )
    out = kept.withColumn("text", F.when(F.size(long) > 0, cut).otherwise(F.col("text")))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.size(long) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*(F.col(aside.get(c, c)).alias(c) for c in columns))


def contamination_report(docs: DataFrame, items: DataFrame, window: int = 10, **options) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = match_spans(docs.select("doc_id", "text"), items, window, **options)
    n_hit = hit_words()
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
