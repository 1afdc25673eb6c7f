"""Storage of intermediate tables and small graph steps that several operators share."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the cluster's ``spark.checkpoint.dir``. Only where that is unset and driver and executors are one process
    (tests) a temporary folder is taken and set; on a cluster a missing folder is an error.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="weft-shared-")
        context.setCheckpointDir(found)
    return found.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, which cuts its lineage.

    A lost executor then costs only a re-read of its splits. The table lives until the shared folder is cleaned.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/weft-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """End the session's Arrow batches at 4 MB, where it has the default: 10,000 rows or 64 MB, held in the JVM and in the
    Python worker each. For rows of whole texts; batches of narrow rows stay as long as before.

    Operators leave the session as it is. The registered queries and the stages of the pipeline call this."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, "4m")


def _give_back() -> None:
    """Return memory that is free to the system: workers live on between stages, idle, beside those that run."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def map_texts(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow(run, schema)``, after which workers give back free memory. For whole texts, ``run`` goes through a
    batch by slices."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _give_back()

    return df.mapInArrow(tidy, schema)


def drop_stored(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the files behind tables made by :func:`stored`."""
    jvm = spark.sparkContext._jvm
    for df in frames:
        for file in df.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            if "/weft-" in folder.toString():
                folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def maybe_marked(df: DataFrame, keys: DataFrame, column: str, name: str, bits: int = 24) -> DataFrame:
    """``df`` with a boolean ``name``: true where ``column`` is among those of ``keys``, and by chance elsewhere.

    A bitmap of ``2 ** bits`` hashed keys is made by aggregation and joined by broadcast. It has at most
    ``2 ** (bits - 6)`` rows of 16 bytes whatever the size of either side; when it fills up, more rows are marked.
    """
    place = F.shiftrightunsigned(F.xxhash64(column), 64 - bits)
    slot, bit = F.shiftrightunsigned(place, 6), place.bitwiseAND(F.lit(63)).cast("int")
    bitmap = keys.select(slot.alias("_slot"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("_bit")).groupBy("_slot").agg(F.bit_or("_bit").alias("_bits"))
    at, held = fresh([*df.columns, name], "slot"), fresh([*df.columns, name], "bits")
    joined = df.withColumn(at, slot).join(F.broadcast(bitmap.select(F.col("_slot").alias(at), F.col("_bits").alias(held))), at, "left")
    found = F.coalesce(F.call_function("shiftrightunsigned", held, bit).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return joined.select(*df.columns, found.alias(name))


def maybe_in(df: DataFrame, keys: DataFrame, column: str, bits: int = 24) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be among those of ``keys``: all that are, and by chance some others. It keeps
    rows that can't match out of the shuffle of a following join."""
    name = fresh(df.columns, "may")
    return maybe_marked(df, keys, column, name, bits).filter(name).select(*df.columns)


def fresh(columns: list[str], name: str) -> str:
    """A column name like ``name`` that none of ``columns`` has, in any case."""
    taken, name = {c.lower() for c in columns}, f"_{name}"
    while name.lower() in taken:
        name += "_"
    return name


def bounded_rows(docs: DataFrame, chosen: DataFrame, most: int) -> DataFrame:
    """``doc_id``, ``text`` and the other columns of ``chosen``, a table of at most ``most`` rows, for the documents whose ids
    it holds: each text of an id once, and ``most`` rows at most, those of least hash, however often an id stands."""
    rest = [c for c in chosen.columns if c != "doc_id"]
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_version"))
    wanted = keyed.select("doc_id", "_version").join(F.broadcast(chosen), "doc_id").distinct()
    wanted = wanted.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "_version", *rest).limit(most)
    return keyed.join(F.broadcast(wanted), ["doc_id", "_version"]).dropDuplicates(["doc_id", "_version", *rest]).select("doc_id", "text", *rest)


def crc32_of_id(column: str = "doc_id") -> Column:
    """CRC-32 of an id written as text, the basis of every hold-out split."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components of ``edges(a long, b long)`` as ``(node, component)``, named by their least node.

    In each round every node points to the least of itself and its neighbours, and on to where that one points; then the
    graph is contracted: edges are relabelled, loops and repeats dropped. "Least" follows another hash in each round but
    the first, so a constant part of the nodes goes on average, whatever the shape of the graph, and a round costs no
    more than the edges that are left. The rounds' pointers are put together from the last to the first. Only the
    number of rounds is known to the driver.
    """
    given = edges.filter("a is not null and b is not null")
    left = stored(given.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    rounds: list[DataFrame] = []
    while left.limit(1).count():
        if len(rounds) == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        order = lambda c, k=len(rounds): F.xxhash64(c, F.lit(k)) if k else F.col(c)
        both = left.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        least = both.select("a", order("b").alias("rank"), "b").groupBy("a").agg(F.min(F.struct("rank", "b")).alias("m"))
        own = F.struct(order("a").alias("rank"), F.col("a").alias("b"))
        near = least.select(F.col("a").alias("node"), F.least("m", own)["b"].alias("to"))
        after = near.select(F.col("node").alias("to"), F.col("to").alias("root"))
        pointer = stored(near.join(after, "to").select("node", F.col("root").alias("to")), "pointers")
        ends = lambda c, p=pointer: p.select(F.col("node").alias(c), F.col("to").alias(f"new_{c}"))
        moved = left.join(ends("a"), "a").join(ends("b"), "b").filter("new_a <> new_b")
        new = stored(moved.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct(), "edges")
        drop_stored(edges.sparkSession, left)
        rounds, left = [*rounds, pointer], new
    found = rounds.pop() if rounds else None
    for pointer in reversed(rounds):
        later = found.select(F.col("node").alias("to"), F.col("to").alias("last"))
        found = pointer.join(later, "to", "left").select("node", F.coalesce("last", "to").alias("to"))
    alone = given.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("to")).distinct()
    if found is None:
        return alone.select("node", F.col("to").alias("component"))
    found = stored(found.unionByName(alone.join(found, "node", "left_anti")), "roots")
    names = found.groupBy("to").agg(F.min("node").alias("component"))
    return found.join(names, "to").select("node", "component")
