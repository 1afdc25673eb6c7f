"""Learns how non-Latin words are spelt in Latin, from pairs of names that are known to match."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.functions.text import script_of, transliterated

INDIC = "[\\u0900-\\u0DFF]"


def latin_words(name: str) -> list[str]:
    return re.sub("[^a-z0-9 ]+", " ", transliterated(name).lower().replace("&", " and ")).split()


def native_words(name: str) -> list[str]:
    return [w for w in re.sub(r"[!-/:-@\[-`{-~]+", " ", name).split() if script_of(w, first_only=True) != "latin"]


def tokenised(pairs: DataFrame) -> DataFrame:
    """``pairs(latin_name, native_name)`` as ``(latin, native)`` word arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[f(x or "") for x in batch.column(c).to_pylist()] for f, c in ((latin_words, "latin_name"), (native_words, "native_name"))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.string())) for c in columns], names=["latin", "native"])

    return pairs.select("latin_name", "native_name").mapInArrow(run, "latin array<string>, native array<string>")


def aligned(words: DataFrame) -> DataFrame:
    """``(native, latin, w)`` of words side by side: weight 1 if both names have as many, 0.5 if the native one has fewer
    (its words then stand for the first of the other), none if it has more."""
    n, m = F.size("native"), F.size("latin")
    usable = words.filter((n > 0) & (n <= m)).withColumn("w", F.when(n == m, 1.0).otherwise(0.5))
    side = F.inline(F.arrays_zip("native", F.slice("latin", 1, n)).cast("array<struct<native:string,latin:string>>"))
    return usable.select("w", side)


def spellings(words: DataFrame, min_count: float = 2, min_share: float = 0.5) -> DataFrame:
    """``(native, latin, w, share)``: the commonest Latin word of each native one, if well supported; ties to the first."""
    counts = words.groupBy("native", "latin").agg(F.sum("w").alias("w"))
    by_word = Window.partitionBy("native")
    ranked = counts.withColumns({"share": F.col("w") / F.sum("w").over(by_word), "k": F.row_number().over(by_word.orderBy(F.desc("w"), "latin"))})
    return ranked.filter((F.col("k") == 1) & (F.col("w") >= min_count) & (F.col("share") >= min_share)).drop("k")


def known_pairs(truth: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Names of matching records of which B's holds Indic letters. ``truth(a_id, b_id)``; raw records on both sides."""
    native = b.filter(F.col("business_name").rlike(INDIC)).select(F.col("entity_id").alias("b_id"), F.col("business_name").alias("native_name"))
    latin = a.select(F.col("entity_id").alias("a_id"), F.col("business_name").alias("latin_name"))
    return truth.join(native, "b_id").join(latin, "a_id").select("latin_name", "native_name")


def learnt(truth: DataFrame, a: DataFrame, b: DataFrame, min_count: float = 2, min_share: float = 0.5) -> DataFrame:
    return spellings(aligned(tokenised(known_pairs(truth, a, b))), min_count, min_share)
