"""Checks of id-list outputs: one row per issue with its severity, count and first examples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ISSUES = "check string, severity string, n long, examples array<string>"
EXAMPLES = 5


def _issue(rows: DataFrame, name: str, severity: str, example: Column) -> DataFrame:
    """One row that counts ``rows``, with the first examples; no row if there are none. Only examples are sorted."""
    some = rows.select(example.cast("string").alias("x"))
    first = some.orderBy("x").limit(EXAMPLES).agg(F.array_sort(F.collect_list("x")).alias("examples"))
    n = some.agg(F.count("*").alias("n")).filter("n > 0")
    return n.withColumn("k", F.lit(1)).join(first.withColumn("k", F.lit(1)), "k").select(F.lit(name).alias("check"), F.lit(severity).alias("severity"), "n", "examples")


def header_issue(header: str | None, expected: list[str]) -> str | None:
    """What is wrong with a header line, if anything: ``empty``, ``commas`` or ``header``."""
    if not header or not header.strip():
        return "empty"
    names = [x.strip().lower() for x in header.split("\t")]
    if names == expected:
        return None
    return "commas" if "\t" not in header and "," in header else "header"


def malformed_lines(lines: DataFrame) -> DataFrame:
    """Lines ``(value)`` that aren't blank and have no tab."""
    return lines.filter((F.instr("value", "\t") == 0) & (F.trim("value") != ""))


def duplicate_keys(lists: DataFrame, key: str) -> DataFrame:
    return lists.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def id_arrays(lists: DataFrame, key: str, ids: str) -> DataFrame:
    """``(key, ids)`` with the list as an array of trimmed, non-empty ids."""
    parts = F.transform(F.split(F.coalesce(ids, F.lit("")), ","), lambda x: F.trim(x))
    return lists.select(F.trim(key).alias("key"), F.filter(parts, lambda x: x != "").alias("ids"))


def duplicate_ids(arrays: DataFrame) -> DataFrame:
    return arrays.filter(F.size("ids") != F.size(F.array_distinct("ids")))


def own_source(arrays: DataFrame, prefix: str = "S1-") -> DataFrame:
    """Listed ids of the key's own source."""
    return arrays.select("key", F.explode("ids").alias("id")).filter(F.col("id").startswith(prefix))


def wrong_prefix(arrays: DataFrame, prefixes: tuple[str, ...] = ("S2-", "S3-"), own: str = "S1-") -> DataFrame:
    known = reduce(lambda x, y: x | y, (F.col("id").startswith(p) for p in (*prefixes, own)))
    return arrays.select("key", F.explode("ids").alias("id")).filter(~known)


def unknown_ids(arrays: DataFrame, known: DataFrame) -> DataFrame:
    """Listed ids that aren't in ``known(id)``."""
    return arrays.select("key", F.explode("ids").alias("id")).join(known.select("id"), "id", "left_anti")


def missing_keys(arrays: DataFrame, required: DataFrame) -> DataFrame:
    return required.select(F.col("id").alias("key")).join(arrays, "key", "left_anti")


def unexpected_keys(arrays: DataFrame, required: DataFrame) -> DataFrame:
    return arrays.join(required.select(F.col("id").alias("key")), "key", "left_anti")


def outside_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """``(key, id)`` of matches that aren't among the key's candidates."""
    pairs = lambda x: x.select("key", F.explode("ids").alias("id"))
    return pairs(matches).join(pairs(candidates), ["key", "id"], "left_anti")


def totals(arrays: DataFrame) -> DataFrame:
    """One row: number of keys, of keys with and without ids, and of ids."""
    return arrays.agg(F.count("*").alias("n_keys"), F.count_if(F.size("ids") > 0).alias("n_filled"), F.count_if(F.size("ids") == 0).alias("n_empty"), F.coalesce(F.sum(F.size("ids")), F.lit(0)).cast("long").alias("n_ids"))


def validated(lists: DataFrame, key: str, ids: str, required: DataFrame | None = None, known: DataFrame | None = None, candidates: DataFrame | None = None) -> DataFrame:
    """All issues of a table of id lists. ``candidates``, another such table, gives warnings only."""
    arrays = id_arrays(lists, key, ids)
    found = [
        _issue(duplicate_keys(arrays, "key"), "duplicate key", "error", F.col("key")),
        _issue(duplicate_ids(arrays), "duplicate id in a list", "error", F.col("key")),
        _issue(own_source(arrays), "id of the key's own source", "error", F.col("id")),
        _issue(wrong_prefix(arrays), "id with a wrong prefix", "error", F.col("id")),
    ]
    if required is not None:
        found.append(_issue(missing_keys(arrays, required), "missing key", "error", F.col("key")))
        found.append(_issue(unexpected_keys(arrays, required), "unexpected key", "error", F.col("key")))
    if known is not None:
        found.append(_issue(unknown_ids(arrays, known), "unknown id", "error", F.col("id")))
    if candidates is not None:
        pairs = outside_candidates(arrays, id_arrays(candidates, candidates.columns[0], candidates.columns[1]))
        found.append(_issue(pairs, "match outside the candidates", "warning", F.concat_ws(" ", "key", "id")))
    return reduce(DataFrame.unionByName, found)


def validate_files(spark: SparkSession, matches: str, candidates: str, required: str, known: list[str] | None = None) -> tuple[int, list[str]]:
    """Exit code (1 if there is an error) and messages for two output files; ``required`` and ``known`` are source files."""
    from weft.sources import files

    messages, ok, tables = [], True, []
    ids = lambda path: files.read_ids(spark, path)
    for path, names in ((matches, files.MATCHES), (candidates, files.CANDIDATES)):
        try:
            wrong = header_issue(files.first_line(spark, path), names)
            if not wrong and files.broken_encoding(spark, path):
                wrong = "not UTF-8"
            broken = 0 if wrong else malformed_lines(files.lines(spark, path)).count()
        except Exception as problem:  # unreadable files end the check, not the program
            return 1, [*messages, f"error: {path}: {type(problem).__name__}"]
        if wrong or broken:
            ok = False
            messages.append(f"error: {path}: {wrong or f'{broken} lines without a tab'}")
        else:
            tables.append(files.read_lists(spark, path, names))
    if len(tables) == 2:
        everything = reduce(DataFrame.unionByName, map(ids, known)) if known else None
        for k, (lists, names) in enumerate(zip(tables, (files.MATCHES, files.CANDIDATES), strict=True)):
            for row in validated(lists, *names, required=ids(required), known=everything, candidates=tables[1] if k == 0 else None).orderBy("severity", "check").collect():
                ok = ok and row.severity != "error"
                messages.append(f"{row.severity}: {row.check}: {row.n}, such as {', '.join(row.examples)}")
    return int(not ok), messages
