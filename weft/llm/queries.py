"""One query for each training-data operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import chat, decontaminate, licenses, linededup, mixing, oracles, pathjoin, quality, repeats, topk, toxicity
from weft.llm.shared import small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(table(spark, sf_dir, "documents"))


#: Weights of the domains in tokens.
TARGETS = {"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1}


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), TARGETS)
    return rows.select("doc_id", "n_tokens", *(F.get("p", F.lit(k)).alias(f"p_{name}") for k, name in enumerate(model.names)), "rate")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.rotated(table(spark, sf_dir, "conversations")))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pathjoin.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op8_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_scores(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def prepared(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``query`` in a session whose Arrow batches fit whole texts."""

    @wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        small_batches(spark)
        return query(spark, *args)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scans": prepared(op1_license_scans),
    "op2_line_dedup": prepared(op2_line_dedup),
    "op3_source_mixing": prepared(op3_source_mixing),
    "op4_toxicity": prepared(op4_toxicity),
    "op5_chat_formatting": prepared(op5_chat_formatting),
    "op6_ngram_jaccard_join": prepared(op6_ngram_jaccard_join),
    "op7_suffix_array_dedup": prepared(op7_suffix_array_dedup),
    "op8_exact_topk_search": prepared(op8_exact_topk_search),
    "op9_quality_classifier": prepared(op9_quality_classifier),
    "op10_benchmark_decontamination": prepared(op10_benchmark_decontamination),
}
ORACLE_SQL: dict[str, str] = {
    "op1_license_scans": licenses.oracle_sql(),
    "op5_chat_formatting": chat.ORACLE_SQL,
    "op6_ngram_jaccard_join": oracles.JACCARD_JOIN,
    "op7_suffix_array_dedup": oracles.REPEATS,
    "op10_benchmark_decontamination": oracles.DECONTAMINATION,
    "op8_exact_topk_search": """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id
), r as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
  from s
)
select query_id, rank, vec_id, score from r where rank <= 20""",
}
