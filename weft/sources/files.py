"""Readers and writers of the file formats, and stage tables from which a run resumes."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weft import schemas

MATCHES = ["source1_entity_id", "matched_entity_ids"]
CANDIDATES = ["source1_entity_id", "candidate_entity_ids"]


def read_tsv(spark: SparkSession, path: str | list[str], schema: StructType = schemas.RAW, mode: str = "FAILFAST") -> DataFrame:
    """Tab-separated text with a header and no quoting; nulls become empty strings. A row with too few or too many fields
    raises."""
    return spark.read.csv(path, sep="\t", header=True, schema=schema, quote="", mode=mode).na.fill("")


def write_tsv(df: DataFrame, path: str, single: bool = False, mode: str = "overwrite") -> None:
    """Tab-separated text without quotes; empty strings are written as nothing. ``single`` makes a folder of one file with
    one header: all tasks write their part, then the parts' bytes are put together without passing through a task."""
    out = df.write.option("sep", "\t").option("quote", "").option("emptyValue", "").option("nullValue", "").mode(mode)
    if not single:
        out.option("header", True).csv(path)
        return
    out.option("header", False).csv(f"{path.rstrip('/')}.parts")
    _joined(df.sparkSession, f"{path.rstrip('/')}.parts", path, "\t".join(df.columns) + "\n")


def _joined(spark: SparkSession, parts: str, path: str, header: str) -> None:
    """The files of ``parts`` behind a header as one file in the folder ``path``, which is replaced; ``parts`` goes."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(path)
    fs = source.getFileSystem(conf)
    fs.delete(target, True)
    stream = fs.create(jvm.org.apache.hadoop.fs.Path(target, "part-00000.csv"))
    try:
        stream.write(bytearray(header.encode()))
        for name in sorted(f.getPath().toString() for f in fs.listStatus(source) if f.getPath().getName().startswith("part-")):
            part = fs.open(jvm.org.apache.hadoop.fs.Path(name))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, stream, conf, False)
            finally:
                part.close()
    finally:
        stream.close()
    fs.create(jvm.org.apache.hadoop.fs.Path(target, "_SUCCESS")).close()
    fs.delete(source, True)


def broken_encoding(spark: SparkSession, path: str) -> int:
    """Number of lines of a text file that aren't valid UTF-8."""
    return lines(spark, path).filter(~F.is_valid_utf8("value")).count()


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, schemas.TRUTH)


def read_lists(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    return read_tsv(spark, path, StructType(schemas._strings(*names)), mode="PERMISSIVE")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value)``: the lines of a text file."""
    return spark.read.text(path)


def first_line(spark: SparkSession, path: str) -> str | None:
    row = lines(spark, path).first()
    return row.value if row else None


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(id)``: distinct first columns of a text file with a header, trimmed; blank lines are skipped."""
    rows = spark.read.csv(path, sep="\t", header=True, quote="", schema="value string", mode="PERMISSIVE")
    return rows.select(F.trim("value").alias("id")).filter("id <> ''").distinct()


def read_parquet(spark: SparkSession, *paths: str, columns: list[str] | None = None) -> DataFrame:
    found = spark.read.parquet(*paths)
    return found.select(*columns) if columns else found


def write_parquet(df: DataFrame, path: str, *partition_by: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_json(spark: SparkSession, path: str) -> dict:
    """A JSON object from any store that Spark reads."""
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(value, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end."""
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(file)


def stage(spark: SparkSession, path: str, make: Callable[[], DataFrame], *partition_by: str) -> DataFrame:
    """The table at ``path``; made and written first, unless an earlier run has done so."""
    if not exists(spark, path):
        write_parquet(make(), path, *partition_by)
    return spark.read.parquet(path)


def with_row_index(df: DataFrame, name: str, *keys: str, path: str) -> DataFrame:
    """``df``, stored at ``path``, with its rows' places from 0 in the order of ``keys``, which tell all rows apart.

    For consumers of positions; nothing here joins on them. Rows are sorted over all tasks, and a task's first place is the
    number of rows of the tasks before it, so no task sees all rows."""
    ordered = df.orderBy(*keys).withColumns({"_task": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    write_parquet(ordered, path)
    found = read_parquet(df.sparkSession, path)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = found.groupBy("_task").agg(F.count("*").alias("n")).withColumn("_first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return found.join(F.broadcast(sizes.select("_task", "_first")), "_task").withColumn(name, F.col("_first") + F.col("_at")).drop("_task", "_at", "_first")


def empty_pairs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.PAIRS)


def listed(df: DataFrame, column: str) -> list:
    """Sorted distinct values of a column of few values, such as countries."""
    return [r[0] for r in df.select(column).distinct().orderBy(column).collect()]
