"""Competition features of the stand-in ``pairs`` where each id stands once, without windows over pairs.

A rank among the pairs of a record is a number of pairs of greater value, and values are hundredths: a histogram over the other
side of the nation, added up from the top, holds all ranks of a record. They are found once for each two balances, and
only these numbers leave numpy: a row for each pair is made last, from blocks of both sides, and none is sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SLICE = 1024  # A at most, about, that one group of rows compares with all B of their nation
_SIDE = 64  # records of either side in one block, a power of two: a block's pairs are held at once
_BLOCKS = 32  # in one batch
_TOP = 10_000  # hundredths of the greatest similarity; codes are one more, 0 stands for null
_NAN = _TOP + 2
_CODES = _TOP + 3
_SUMS = 3 * (2 * _TOP + 1)  # sums of two similarities; as doubles, equal sums may differ in the last place
_HELD = 1 << 26  # bytes of ranks held at once
_AT_ONCE = 1 << 17  # cells of histograms at once

_A = "a_id i a_most a_sum n_tsr_max combo_max n_hi_name n_house_eq n_name_eq n_both_eq a_twins a_place".split()
_B = "b_id j b_tsr b_most b_combo_max b_deg b_name_eq_cnt b_house_eq_cnt a_tsr_rank a_tsr_gap n_cands a_tsr_max n_hi_addr b_other b_place".split()
_TYPES = {"a_id": T.StringType(), "b_id": T.StringType(), "i": T.IntegerType(), "j": T.IntegerType(), "a_twins": T.BooleanType(), "b_other": T.BooleanType()}
_NULLABLE = {"a_id", "b_id", "n_tsr_max", "a_tsr_max", "a_tsr_gap"}


def _lists() -> T.StructType:
    """Of blocks. Most fields can't be null, which saves a check for each pair."""
    records = lambda names: T.ArrayType(T.StructType([T.StructField(c, _TYPES.get(c, T.DoubleType()), c in _NULLABLE) for c in names]), False)
    types = {"by_a": T.ArrayType(T.LongType(), False), "by_b": T.ArrayType(T.LongType(), False), "b": records(_B), "a": records(_A)}
    return T.StructType([T.StructField(c, t, False) for c, t in types.items()])


def _codes(a, a_null, b, b_null) -> np.ndarray:
    """Hundredths of ``n_tsr`` and one; 0 for null, ``_NAN`` for what is no number."""
    with np.errstate(invalid="ignore"):
        x = np.floor(100 / (1 + np.abs(a - b) / 2000) * 1e2 + 0.5) + 1
    np.copyto(x, _NAN, where=np.isnan(x))
    np.copyto(x, 0, where=a_null | b_null)
    return x.astype(np.int64)


def _clipped(codes: np.ndarray) -> np.ndarray:
    """Hundredths from 0 to 100: bounds are taken over null and no number too."""
    return np.where((codes == 0) | (codes == _NAN), _TOP, codes - 1)


def _rounded(x: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore"):
        return np.where(np.abs(x) < 1e12, np.copysign(np.floor(np.abs(x) * 1e4 + 0.5) / 1e4, x), x) + 0.0


def _ordered(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by keys, and in this order where a new key begins."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in (k[order] for k in keys):
        new[1:] |= (k[1:] != k[:-1]) & ~((k[1:] != k[1:]) & (k[:-1] != k[:-1]))
    new[:1] = True
    return order, new


def _equal(keys: np.ndarray, n: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """How many of the keys equal each one asked for; null (no number here) equals none."""
    if not len(keys):
        return np.zeros(len(asked))
    values, which = np.unique(keys, return_inverse=True)
    at = np.minimum(np.searchsorted(values, asked), len(values) - 1)
    return np.where(values[at] == asked, np.bincount(which, n)[at], 0.0)


class _Group:
    """A slice of the A of a nation, balances of all A, and all B."""

    def __init__(self, rows: pa.Table):
        kind = rows["kind"].to_numpy()
        one, every, two = (rows.filter(pa.array(kind == k)).combine_chunks() for k in range(3))
        number = lambda t, c: t[c].to_numpy().astype(float)
        null = lambda t, c: t[c].is_null().to_numpy()
        self.all, self.all_null, self.n_all = number(every, "bal"), null(every, "bal"), number(every, "n")
        self.some = bool(one.num_rows and two.num_rows)
        if self.some:
            self._take_a(one, two, number, null)
            self._take_b(every, two, number, null)

    def _take_a(self, one, two, number, null) -> None:
        order, self.a_new = _ordered(null(one, "bal"), number(one, "bal"))
        one = one.take(pa.array(order))
        self.a_id, self.a_bal, self.a_null = one["id"], number(one, "bal"), null(one, "bal")
        house, half = number(one, "house"), number(one, "half")
        other = two.filter(pa.array(~two["building"].to_numpy()))
        ones, others = np.ones(two.num_rows), np.ones(other.num_rows)
        both = lambda t: number(t, "house") + 1j * number(t, "half")
        self.a_counts = [_equal(number(other, "house"), others, house), _equal(number(two, "half"), ones, half), _equal(both(other), others, house + 1j * half)]
        self.a_place = np.where(np.isnan(house), -0.5, house)

    def _take_b(self, every, two, number, null) -> None:
        tsr, unknown = number(two, "tsr"), null(two, "tsr")
        order, self.b_new = _ordered(null(two, "bal"), number(two, "bal"), unknown, tsr)
        two, tsr, unknown = two.take(pa.array(order)), tsr[order], unknown[order]
        house, half, building = number(two, "house"), number(two, "half"), two["building"].to_numpy()
        starts = np.flatnonzero(self.b_new)
        self.b_bal, self.b_null = number(two, "bal")[starts], null(two, "bal")[starts]
        self.n_b = np.diff(np.append(starts, len(order))).astype(float)
        clipped = np.clip(np.where(np.isnan(tsr), 100, tsr), 0, 100)
        tsr_code = np.rint(clipped * 100).astype(np.int64)
        self.tsr, self.tsr_code = clipped[starts], tsr_code[starts]
        known, no_number = tsr[~unknown], np.isnan(tsr) & ~unknown
        values, n = np.unique(np.where(np.isnan(known), np.inf, known), return_counts=True)
        above = np.append(np.cumsum(n[::-1])[::-1], 0)
        rank = 1 + above[np.searchsorted(values, np.where(no_number, np.inf, tsr), "right")]
        most = np.nan if no_number.any() else known.max() if len(known) else np.nan
        size = two.num_rows
        with np.errstate(invalid="ignore"):
            gap = _rounded(most - tsr)
        of_all = lambda x: np.full(size, float(x))
        self.b_columns = {
            "b_id": two["id"].combine_chunks() if isinstance(two["id"], pa.ChunkedArray) else two["id"],
            "b_tsr": tsr_code.astype(float), "b_deg": of_all(self.n_all.sum()),
            "b_name_eq_cnt": _equal(number(every, "half"), self.n_all, half),
            "b_house_eq_cnt": np.where(building, 0.0, _equal(number(every, "house"), self.n_all, house)),
            "a_tsr_rank": np.where(unknown, 1.0 + len(known), rank), "a_tsr_gap": pa.array(gap, mask=unknown),
            "n_cands": of_all(size), "a_tsr_max": pa.array(of_all(_rounded(np.array(float(most)))), mask=np.full(size, not len(known))),
            "n_hi_addr": of_all(((known >= 90) | np.isnan(known)).sum()), "b_other": ~building, "b_place": np.where(np.isnan(house), -1.5, house),
        }

    def among_b(self, keys: slice, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each B key, ranks of the A keys ``of`` among all A, and its greatest similarity. A B's ``a_tsr`` is one, so its
        pairs stand in the order of ``n_tsr``."""
        b, b_null = self.b_bal[keys], self.b_null[keys]
        total, single = self.n_all.sum(), (self.n_all == 1).all()
        ranks = np.empty((len(b), len(of)), np.uint16 if total < 1 << 16 else np.int64)
        most, step = np.empty(len(b), np.int64), max(1, _AT_ONCE // max(_CODES, len(self.all)))
        for k in range(0, len(b), step):
            bal, unknown = b[k : k + step, None], b_null[k : k + step, None]
            code = _clipped(_codes(self.all, self.all_null, bal, unknown))
            most[k : k + step] = code.max(axis=1)
            rows = np.arange(len(bal))[:, None] * _CODES
            n = None if single else np.broadcast_to(self.n_all, code.shape).ravel()
            n = np.bincount((code + rows).ravel(), n, len(bal) * _CODES).astype(np.int64, copy=False)  # added up faster than doubles
            below = np.cumsum(n.reshape(len(bal), _CODES), axis=1)
            mine = _clipped(_codes(self.a_bal[of], self.a_null[of], bal, unknown))
            ranks[k : k + step] = 1 + total - np.take_along_axis(below, mine, axis=1)
        return ranks, most

    def among_a(self, of: np.ndarray, keys: slice) -> tuple[np.ndarray, ...]:
        """Of each A key, codes and ranks of the B keys by ``n_tsr`` and by the sum, and its greatest values and counts."""
        total, width = self.n_b.sum(), keys.stop - keys.start
        codes, by_name, by_sum = np.empty((len(of), width), np.int16), np.empty((len(of), width), np.int64), np.empty((len(of), width), np.int64)
        most = np.empty((3, len(of)), np.int64)
        for k, x in enumerate(of):
            code = _codes(self.a_bal[x], self.a_null[x], self.b_bal, self.b_null)
            below = np.cumsum(np.bincount(code, self.n_b, _CODES).astype(np.int64))
            clipped = _clipped(code)
            both = clipped + self.tsr_code
            exact, plain = clipped / 100 / 2 + self.tsr / 2, both / 200
            key = 3 * both + 1 + (exact > plain) - (exact < plain)
            lower = np.cumsum(np.bincount(key, self.n_b, _SUMS).astype(np.int64))
            codes[k], by_name[k], by_sum[k] = code[keys], 1 + total - below[code[keys]], 1 + total - lower[key[keys]]
            most[:, k] = code.max(), both.max(), total - below[9000]
        return codes, by_name, by_sum, most

    def blocks(self) -> Iterator[pa.RecordBatch]:
        if not self.some:
            return
        a_first, b_first = np.flatnonzero(self.a_new), np.flatnonzero(self.b_new)
        total = self.n_all.sum()
        step = max(1, _HELD // (len(a_first) * (2 if total < 1 << 16 else 8)))
        a_key = np.cumsum(self.a_new) - 1
        for low in range(0, len(b_first), step):
            high = min(low + step, len(b_first))
            ranks, most = self.among_b(slice(low, high), a_first)
            start, stop = b_first[low], b_first[high] if high < len(b_first) else len(self.b_new)
            at = np.arange(stop - start)
            new = self.b_new[start:stop] | (at % _SIDE == 0)
            local = np.cumsum(new) - 1  # keys of blocks: a key that two blocks share is one in each
            key = (np.cumsum(self.b_new[start:stop]) - 1)[new]
            key_of, column = (np.cumsum(self.b_new[start:stop]) - 1), self.b_columns
            b_columns = {c: v.slice(start, stop - start) if isinstance(v, pa.Array) else pa.array(v[start:stop]) for c, v in column.items()}
            b_columns["j"] = pa.array(((local - local[at - at % _SIDE]) * _SIDE).astype(np.int32))
            b_columns["b_most"] = pa.array(most[key_of].astype(float))
            b_columns["b_combo_max"] = pa.array((most[key_of] + column["b_tsr"][start:stop]) / 200)
            b = _struct(b_columns, _B)
            for first in range(0, len(a_key), _SIDE):
                chunk = slice(first, min(first + _SIDE, len(a_key)))
                yield from self._block(chunk, a_key[chunk], a_first, slice(low, high), ranks, b, local, key)

    def _block(self, chunk, a_key, a_first, keys, ranks, b, local, key) -> Iterator[pa.RecordBatch]:
        least, n = a_key[0], a_key[-1] - a_key[0] + 1
        codes, by_name, by_sum, most = self.among_a(a_first[least : least + n], keys)
        mine = a_key - least
        top, sums, high = (x[mine] for x in most)
        house, name, both = (x[chunk] for x in self.a_counts)
        a = _struct({
            "a_id": _whole(self.a_id.slice(chunk.start, chunk.stop - chunk.start)), "i": pa.array(mine.astype(np.int32)), "a_most": pa.array(np.where(top == _NAN, np.nan, top)),
            "a_sum": pa.array(sums.astype(float)), "n_tsr_max": pa.array(np.where(top == _NAN, np.nan, (top - 1) / 100), mask=top == 0), "combo_max": pa.array(sums / 200),
            "n_hi_name": pa.array(high.astype(float)), "n_house_eq": pa.array(house), "n_name_eq": pa.array(name), "n_both_eq": pa.array(both), "a_twins": pa.array(both > 0), "a_place": pa.array(self.a_place[chunk]),
        }, _A)
        size, again = len(a), pa.array(np.tile(np.arange(len(a)), _BLOCKS))
        repeated = a.take(again)
        for start in range(0, len(b), _SIDE * _BLOCKS):
            stop = min(start + _SIDE * _BLOCKS, len(b))
            rows = -(-(stop - start) // _SIDE)
            cuts = np.minimum(start + _SIDE * np.arange(rows + 1), stop)
            ends = np.append(local[cuts[:-1]], local[stop - 1] + 1)
            k = key[ends[0] : ends[-1]]
            by_a, by_b = np.zeros((2, len(k), _SIDE), np.int64)
            by_a[:, :n] = (by_name[:, k] << 32 | by_sum[:, k]).T
            by_b[:, :n] = ranks[k, least : least + n].astype(np.int64) << 32 | (codes[:, k].astype(np.int64) << 16 | _clipped(codes[:, k])).T
            offsets = pa.array(((ends - ends[0]) * _SIDE).astype(np.int32))
            lists = lambda x: pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))  # noqa: B023, E731
            yield pa.record_batch({
                "by_a": lists(by_a), "by_b": lists(by_b),
                "b": pa.ListArray.from_arrays(pa.array((cuts - start).astype(np.int32)), b.slice(start, stop - start)),
                "a": pa.ListArray.from_arrays(pa.array((size * np.arange(rows + 1)).astype(np.int32)), repeated.slice(0, size * rows)),
            })


def _whole(x):
    return x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x


def _struct(columns: dict[str, pa.Array], names: list[str]) -> pa.StructArray:
    return pa.StructArray.from_arrays([columns[c] for c in names], names)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows sorted by group."""
    now, held = None, []
    for batch in batches:
        group = batch["group"].to_numpy()
        cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if start == end:
                continue
            if held and group[start] != now:
                yield from _Group(pa.Table.from_batches(held)).blocks()
                held = []
            now = group[start]
            held.append(batch.slice(start, end - start))
    if held:
        yield from _Group(pa.Table.from_batches(held)).blocks()


def _groups(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nations that have pairs, in how many groups their A are dealt, and the number of the first one."""
    n = lambda x, name: x.groupBy("nation").agg(F.count("*").alias(name))
    nations = n(a, "na").join(n(b, "nb"), "nation").withColumn("pairs", F.col("na").cast("double") * F.col("nb"))
    every = Window.partitionBy(F.lit(0))
    share = F.ceil(4 * a.sparkSession.sparkContext.defaultParallelism * F.col("pairs") / F.sum("pairs").over(every))
    deals = nations.withColumn("deals", F.least(F.col("na"), F.greatest(F.ceil(F.col("na") / _SLICE), share)))
    return deals.select(F.col("nation").alias("_nation"), "deals", (F.sum("deals").over(every.orderBy("nation")) - F.col("deals")).alias("first"))


def competition(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(a_id, b_id)`` and the competition features, rounded to 4 places, of each pair of two records of a nation. Each id
    may stand once in its side."""
    spark, groups = a.sparkSession, _groups(a, b)
    dealt = lambda x: x.join(groups, F.col("nation") == F.col("_nation"))
    columns = lambda s, identifier, n, tsr, building: [identifier.alias("id"), F.col(f"{s}_bal").cast("double").alias("bal"), F.col(f"{s}_house").cast("double").alias("house"), F.col(f"{s}_half").cast("double").alias("half"), tsr.cast("double").alias("tsr"), building.alias("building"), n.cast("long").alias("n")]
    none, one, no = F.lit(None).cast("string"), F.lit(1), F.lit(False)
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1))
    group = lambda deal: (F.col("first") + deal).alias("group")
    same = a.groupBy("nation", "a_bal", "a_house", "a_half").agg(F.count("*").alias("same"))
    rows = dealt(a).select(group(F.pmod(F.xxhash64("a_id"), F.col("deals"))), F.lit(0).alias("kind"), *columns("a", F.col("a_id"), one, F.lit(None), no))
    rows = rows.unionByName(dealt(same).withColumn("deal", each).select(group(F.col("deal")), F.lit(1).alias("kind"), *columns("a", none, F.col("same"), F.lit(None), no)))
    rows = rows.unionByName(dealt(b).withColumn("deal", each).select(group(F.col("deal")), F.lit(2).alias("kind"), *columns("b", F.col("b_id"), one, F.col("a_tsr"), F.col("b_building"))))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * spark.sparkContext.defaultParallelism)
    rows = rows.repartitionById(tasks, F.pmod("group", F.lit(tasks)).cast("int")).sortWithinPartitions("group")
    met = rows.mapInArrow(_blocks, _lists()).select("by_a", "by_b", "a", F.inline("b")).select("*", F.inline("a"))
    place = F.col("j").bitwiseOR(F.col("i"))
    met = met.withColumns({c: F.coalesce(F.get(f"by_{c[-1]}", place), F.lit(0).cast("long")) for c in ("of_a", "of_b")})
    bits = lambda c, shift, mask: F.shiftright(c, shift).bitwiseAND(F.lit(mask).cast("long")).cast("double")
    met = met.withColumns({"code": bits("of_b", 16, 0xFFFF), "hundredths": bits("of_b", 0, 0xFFFF)})
    both = F.col("hundredths") + F.col("b_tsr")
    made = {
        "combo": both / 200.0,
        "n_tsr_rank": F.shiftright("of_a", 32).cast("double"),
        "n_tsr_gap": F.when(F.col("code") != 0.0, (F.col("a_most") - F.col("code")) / 100.0),
        "combo_gap": (F.col("a_sum") - both) / 200.0,
        "b_combo_gap": (F.col("b_most") - F.col("hundredths")) / 200.0,
        "combo_rank": bits("of_a", 0, 0xFFFFFFFF),
        "b_combo_rank": F.shiftright("of_b", 32).cast("double"),
        "twin_better": F.when(F.col("a_twins") & F.col("b_other") & (F.col("a_place") != F.col("b_place")), 1.0).otherwise(0.0),
    }
    kept = "n_cands n_tsr_max a_tsr_max a_tsr_rank a_tsr_gap combo_max n_hi_name n_hi_addr n_house_eq n_name_eq n_both_eq b_deg b_combo_max b_name_eq_cnt b_house_eq_cnt".split()
    return met.select("a_id", "b_id", *(v.alias(k) for k, v in made.items()), *kept)
