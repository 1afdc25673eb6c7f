"""The whole chain: learn spellings, normalise, retrieve, compare, score, decide, write. Each stage is a table under a work
folder, so that a run which is started again goes on where it ended."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions.text import normalised
from weft.operators import decide, dictionary
from weft.operators.blocking import ADDRESS, NAME, candidate_pairs
from weft.operators.features import hash_sample, pair_features
from weft.plans import model as models
from weft.sources import files

#: Learnt spellings that are sent to the normaliser, the best supported ones: a dictionary of words, not of names.
MOST_SPELLINGS = 1_000_000


def matches(scored: DataFrame, config: models.Config, stack: tuple[PipelineModel, models.Config] | None = None) -> DataFrame:
    """Decided pairs. A second stage replaces probabilities and threshold, and group thresholds don't hold then."""
    if stack:
        second, its = stack
        return decide.decided(models.apply_stack(scored, second), its.threshold, its.one_to_one)
    return decide.decided(models.with_group(scored), config.threshold, config.one_to_one, config.groups)


def link(a: DataFrame, b: DataFrame, model: PipelineModel, config: models.Config, stack: tuple[PipelineModel, models.Config] | None = None) -> DataFrame:
    """Matches ``(a_id, b_id, p)`` of normalised records."""
    found = models.scored(pair_features(candidate_pairs(a, b), a, b), model)
    return matches(found, config, stack).select("a_id", "b_id", "p")


def prepare(spark: SparkSession, work: str, a_path: str, b_paths: list[str], truth_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Normalised tables of both sides; spellings are learnt if there is a truth."""
    raw_a, raw_b = files.read_tsv(spark, a_path), files.read_tsv(spark, b_paths)
    words = {}
    if truth_path:
        learn = lambda: dictionary.learnt(decide.truth_pairs(files.read_truth(spark, truth_path)), raw_a, raw_b)
        words = {r.native: r.latin for r in files.stage(spark, f"{work}/spellings", learn).orderBy(F.desc("w"), "native").limit(MOST_SPELLINGS).collect()}
    side = lambda name, raw: files.stage(spark, f"{work}/{name}", lambda: normalised(raw, words), "country")
    return side("a", raw_a), side("b", raw_b)


def block(spark: SparkSession, work: str, a: DataFrame, b: DataFrame, sample: float = 1.0, seed: int = 7, top_name: int | None = None, top_address: int | None = None) -> DataFrame:
    """Candidate pairs of a share of A's records, with as many matches of each by name and address as wanted."""
    asked = hash_sample(a, sample, seed, "entity_id") if sample < 1 else a
    channels = (replace(NAME, forward=top_name or NAME.forward), replace(ADDRESS, forward=top_address or ADDRESS.forward))
    return files.stage(spark, f"{work}/pairs", lambda: candidate_pairs(asked, b, channels))


def compare(spark: SparkSession, work: str, a: DataFrame, b: DataFrame, pairs: DataFrame, country: str | None = None) -> DataFrame:
    """Features of the pairs, of one country if named; ambiguity is counted over all of A."""
    own = a.filter(F.col("country") == country) if country else a
    path = f"{work}/features-{country}" if country else f"{work}/features"
    return files.stage(spark, path, lambda: pair_features(pairs, own, b, a))


def train(spark: SparkSession, work: str, a_path: str, b_paths: list[str], truth_path: str, states: list[str] | None = None, **options) -> models.Config:
    """Fit and store both stages under ``work``, on entities of some ``states`` if named. The second is stored only if it
    scores better than the first on the same entities."""
    a, b = prepare(spark, work, a_path, b_paths, truth_path)
    truth = decide.truth_pairs(files.read_truth(spark, truth_path))
    features = compare(spark, work, a, b, block(spark, work, a, b))
    entities = (a.filter(F.col("state").isin(states)) if states else a).select(F.col("entity_id").alias("a_id"))
    features = features.join(entities, "a_id", "left_semi") if states else features
    model, config = models.train(features, truth, entities, **options)
    models.save(spark, model, config, f"{work}/first")
    unseen = lambda x: x.filter(models.fold() != models.TRAIN)
    rows = models.scored(unseen(features), model)
    second, its = models.train_stack(rows, truth, unseen(entities))
    if its.macro_f05 > decide.best_threshold(rows, truth, unseen(entities))[2]:
        models.save(spark, second, its, f"{work}/second")
    return config


def predict(spark: SparkSession, work: str, model_path: str, a_path: str, b_paths: list[str], out: str, stage: str = "second", country: str | None = None) -> None:
    """Write ``matching_results.tsv`` and ``candidate_pairs.tsv`` under ``out``, a row for each A (of a country, if named) in
    both. ``stage`` is that whose probabilities decide."""
    a, b = prepare(spark, work, a_path, b_paths)
    pairs = block(spark, work, a, b)
    model, config = models.load(spark, f"{model_path}/first")
    stack = models.load(spark, f"{model_path}/second") if stage == "second" and files.exists(spark, f"{model_path}/second/config") else None
    found = files.stage(spark, f"{work}/scored-{country}" if country else f"{work}/scored", lambda: models.scored(compare(spark, work, a, b, pairs, country), model))
    entities = (a.filter(F.col("country") == country) if country else a).select(F.col("entity_id").alias("a_id"))
    asked = pairs.join(entities, "a_id", "left_semi")
    files.write_tsv(decide.match_lists(matches(found, config, stack), entities, *files.MATCHES), f"{out}/matching_results.tsv", single=True)
    files.write_tsv(decide.match_lists(asked, entities, *files.CANDIDATES), f"{out}/candidate_pairs.tsv", single=True)
