"""From probabilities to matches: thresholds, one A for each B, and their quality."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_of_each(rows: DataFrame, key: str = "b_id") -> DataFrame:
    """The row of greatest ``p`` for each key; ties to the smaller A."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("p"), "a_id"))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def group_key(addr_missing: Column, amb_name: Column, n_cands: Column) -> Column:
    """4 without an address, plus 2 for an ambiguous name, plus 1 for a single candidate."""
    bit = lambda x, n: x.cast("int") * n
    return bit(addr_missing > 0, 4) + bit(amb_name > 1, 2) + bit(n_cands <= 1, 1)


def limit(group: Column, groups: dict[int, float], start: float) -> Column:
    """The threshold of a pair's group, ``start`` for others."""
    out = F.lit(float(start))
    for g, value in groups.items():
        out = F.when(group == g, float(value)).otherwise(out)
    return out


def decided(scored: DataFrame, threshold: float, one_to_one: bool = True, groups: dict[int, float] | None = None) -> DataFrame:
    """Matches of ``scored(a_id, b_id, p[, g])``. With ``groups`` each group has a threshold of its own, and pairs are held
    against it before the best is chosen: the best pair of a B may fail where a lesser one passes."""
    kept = scored.filter(F.col("p") >= (limit(F.col("g"), groups, threshold) if groups else F.lit(threshold)))
    return best_of_each(kept) if one_to_one else kept


def f_half(precision: Column, recall: Column) -> Column:
    return F.coalesce(1.25 * precision * recall / F.nullif(0.25 * precision + recall, F.lit(0.0)), F.lit(0.0))


def entity_scores(truth: DataFrame, matches: DataFrame, entities: DataFrame, *by: str) -> DataFrame:
    """``(a_id, *by, n_true, n_pred, tp, score)``: F0.5 of each entity; 1 if it has neither truth nor match."""
    keys = ["a_id", *by]
    n_true = truth.groupBy("a_id").agg(F.count("*").alias("n_true"))
    hits = truth.select("a_id", "b_id").withColumn("hit", F.lit(1))
    found = matches.join(hits, ["a_id", "b_id"], "left").groupBy(*keys).agg(F.count("*").alias("n_pred"), F.count("hit").alias("tp"))
    rows = entities.join(n_true, "a_id", "left").join(found, keys, "left").na.fill(0, ["n_true", "n_pred", "tp"])
    both = (F.col("n_true") > 0) & (F.col("n_pred") > 0)
    p, r = (F.col("tp") / F.nullif(F.col(n), F.lit(0)) for n in ("n_pred", "n_true"))
    score = F.when((F.col("n_true") == 0) & (F.col("n_pred") == 0), 1.0).when(both, f_half(p, r)).otherwise(0.0)
    return rows.withColumn("score", score)


def macro_f_half(truth: DataFrame, matches: DataFrame, entities: DataFrame) -> DataFrame:
    """One row: the mean score over ``entities``. Matches of other entities don't count."""
    return entity_scores(truth, matches, entities).agg(F.avg("score").alias("macro_f05"))


def _macro_by(passed: DataFrame, truth: DataFrame, entities: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """``(key, macro_f05)`` for every row of ``values(key)``, of matches ``passed(a_id, b_id, key)``. Entities are counted,
    not repeated for each value."""
    hits = truth.select("a_id", "b_id").withColumn("hit", F.lit(1))
    found = passed.join(hits, ["a_id", "b_id"], "left").groupBy("a_id", key).agg(F.count("*").alias("n_pred"), F.count("hit").alias("tp"))
    return macro_of_counts(found, truth, entities, key, values)


def macro_of_counts(found: DataFrame, truth: DataFrame, entities: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """``(key, macro_f05)`` for every row of ``values(key)``, of ``found(a_id, key, n_pred, tp)``: how many matches each entity
    has, and how many of them are true."""
    n_true = truth.groupBy("a_id").agg(F.count("*").alias("n_true"))
    found = found.join(entities, "a_id", "left_semi").join(n_true, "a_id", "left").na.fill(0, ["n_true"])
    p, r = F.col("tp") / F.col("n_pred"), F.col("tp") / F.nullif(F.col("n_true"), F.lit(0))
    by_value = found.groupBy(key).agg(F.sum(F.when(F.col("n_true") > 0, f_half(p, r)).otherwise(0.0)).alias("gained"), F.sum((F.col("n_true") == 0).cast("int")).alias("spoilt"))
    total, empty = entities.join(n_true, "a_id", "left").agg(F.count("*"), F.count_if(F.col("n_true").isNull())).first()
    counts = values.join(by_value, key, "left").na.fill(0.0, ["gained"]).na.fill(0, ["spoilt"])
    return counts.select(key, ((F.col("gained") + F.lit(float(empty)) - F.col("spoilt")) / F.nullif(F.lit(float(total)), F.lit(0.0))).alias("macro_f05"))


def threshold_sweep(scored: DataFrame, truth: DataFrame, entities: DataFrame, thresholds: list[float], one_to_one: bool = True) -> DataFrame:
    """``(threshold, macro_f05)`` of every threshold in one job. The best pair of a B doesn't depend on a threshold that is
    the same for all, so it is chosen once."""
    best = best_of_each(scored) if one_to_one else scored
    grid = F.array(*map(F.lit, thresholds))
    passed = best.select("a_id", "b_id", F.explode(F.filter(grid, lambda t: F.col("p") >= t)).alias("threshold"))
    return _macro_by(passed, truth, entities, "threshold", _grid(entities, thresholds))


def _grid(entities: DataFrame, thresholds: list[float]) -> DataFrame:
    return entities.sparkSession.createDataFrame([(t,) for t in thresholds], "threshold double")


def trial_scores(scored: DataFrame, truth: DataFrame, entities: DataFrame, start: float, trials: list[dict[int, float]], one_to_one: bool = True) -> list[float]:
    """The score of each of several sets of group thresholds, all in one job: a pair is repeated for the trials it passes."""
    group = F.coalesce(F.col("g"), F.lit(0)) + 1
    rows = F.array(*(F.array(*(F.lit(float(t.get(g, start))) for g in range(8))) for t in trials))
    passing = F.filter(F.sequence(F.lit(1), F.lit(len(trials))), lambda k: F.col("p") >= F.element_at(F.element_at(rows, k), group.cast("int")))
    passed = scored.select("a_id", "b_id", "p", F.explode(passing).alias("trial"))
    if one_to_one:
        rank = F.row_number().over(Window.partitionBy("trial", "b_id").orderBy(F.desc("p"), "a_id"))
        passed = passed.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    return scores_of_trials(passed, truth, entities, len(trials))


def scores_of_trials(passed: DataFrame, truth: DataFrame, entities: DataFrame, trials: int) -> list[float]:
    """The score of each trial of ``passed(a_id, b_id, trial)``."""
    values = entities.sparkSession.range(1, trials + 1).select(F.col("id").cast("int").alias("trial"))
    return [r.macro_f05 or 0.0 for r in _macro_by(passed, truth, entities, "trial", values).orderBy("trial").collect()]


def best_threshold(scored: DataFrame, truth: DataFrame, entities: DataFrame, reached: Callable[[list[float]], DataFrame] | None = None) -> tuple[float, bool, float]:
    """Threshold, whether one A for each B is better, and the score: a coarse grid, then a fine one around its best.

    ``reached`` gives ``(a_id, threshold, n_pred, tp)`` of all pairs for a grid, if they can be counted without making them;
    then ``scored`` may hold no more than the best pair of each B."""
    coarse = [round(0.20 + 0.05 * k, 2) for k in range(16)]
    top = None

    def sweep(grid: list[float], one_to_one: bool) -> DataFrame:
        if reached and not one_to_one:
            return macro_of_counts(reached(grid), truth, entities, "threshold", _grid(entities, grid))
        return threshold_sweep(scored, truth, entities, grid, one_to_one)

    for one_to_one in (True, False):
        rows = sweep(coarse, one_to_one)
        near = rows.orderBy(F.desc("macro_f05"), "threshold").first()
        fine = sorted({round(near.threshold + 0.01 * k, 2) for k in range(-5, 6)})
        row = sweep(fine, one_to_one).orderBy(F.desc("macro_f05"), "threshold").first()
        if top is None or row.macro_f05 > top[2]:
            top = (row.threshold, one_to_one, row.macro_f05)
    return top


def group_thresholds(scored: DataFrame, truth: DataFrame, entities: DataFrame, start: float, one_to_one: bool = True, grid: list[float] | None = None, passes: int = 2, least_gain: float = 1e-6) -> tuple[dict[int, float], float]:
    """Coordinate search for a threshold of each group (at most 8) and the score it gives. ``scored`` should be stored. All
    values of a group are scored by one job, as only this group's threshold differs between them."""
    grid = grid or [round(0.30 + 0.05 * k, 2) for k in range(14)]
    groups = {r.g: start for r in scored.select("g").distinct().collect()}
    best = trial_scores(scored, truth, entities, start, [groups], one_to_one)[0]
    for _ in range(passes):
        for g in sorted(groups):
            found = trial_scores(scored, truth, entities, start, [groups | {g: value} for value in grid], one_to_one)
            for value, score in zip(grid, found, strict=True):
                if score > best + least_gain:
                    groups, best = groups | {g: value}, score
    return groups, best


def match_lists(matches: DataFrame, entities: DataFrame, source: str = "source1_entity_id", target: str = "matched_entity_ids") -> DataFrame:
    """A row for each entity with its sorted, comma-joined matches, empty if it has none."""
    lists = matches.groupBy("a_id").agg(F.array_join(F.sort_array(F.collect_list("b_id")), ",").alias("ids"))
    return entities.join(lists, "a_id", "left").select(F.col("a_id").alias(source), F.coalesce("ids", F.lit("")).alias(target))


def recall_report(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: true pairs, how many were retrieved in all and by either channel, and shares of pairs and whole entities."""
    marked = truth.select("a_id", "b_id").join(candidates.select("a_id", "b_id", "sim_name", "sim_addr", F.lit(1).alias("hit")), ["a_id", "b_id"], "left")
    per_entity = marked.groupBy("a_id").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("r"), F.count("*").alias("n"), F.count("hit").alias("hits"), F.count_if(F.col("sim_name") > 0).alias("by_name"), F.count_if(F.col("sim_addr") > 0).alias("by_addr"))
    n = F.sum("n")
    return per_entity.agg(
        n.alias("n_true"), F.sum("hits").alias("n_found"), (F.sum("hits") / n).alias("pair_recall"), (F.sum("by_name") / n).alias("name_recall"),
        (F.sum("by_addr") / n).alias("addr_recall"), F.avg("r").alias("entity_recall"), F.avg((F.col("r") == 1).cast("int")).alias("full_entity_recall"),
    )


def truth_pairs(lists: DataFrame) -> DataFrame:
    """``(a_id, b_id)`` from ground-truth lists; empty lists give no row."""
    ids = F.explode(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","))
    return lists.select(F.col("source1_entity_id").alias("a_id"), ids.alias("b_id")).filter("b_id <> ''")
