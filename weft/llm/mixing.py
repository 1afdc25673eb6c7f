"""Mixing documents to target domain weights with soft domain membership.

A multinomial classifier over hashed words, fitted on labelled rows, gives each document posteriors over domains. Words
aren't independent, so a part of the labelled rows that the word counts don't see calibrates the evidence: it is scaled
by ``scale * n ** -power`` (n is the number of words), of all pairs of a grid the one of least log loss.

Nonnegative rates (how often to use a document) are then fitted by projected-gradient least squares, so that the
expected tokens of each domain, sum of rate * tokens * posterior, meet their targets:

    minimise  1/2 sum_k (E_k(r) - T_k)^2 / N_k   over  r >= 0,   from r = 1

where N_k are the expected tokens at rate 1. In the metric of token counts the gradient of a document is
``sum_k p_k (E_k - T_k) / N_k``, and as posteriors sum to 1 a step of length 1 never overshoots. A step is one
aggregation of as many sums as there are domains; the rate of a document is a function of its posteriors and of these
sums alone, so no rates are stored or shuffled between steps. Steps end when the sums stand still; the model keeps
whether they did and how far from their targets they are, as targets may be out of reach.

Everything is made of SQL expressions. The classifier takes at most ``max_fit_rows`` labelled rows (documented bound,
20,000, chosen by hash of the id); targets and sums cover all documents.

Defined results: null, empty and wordless texts have no tokens and the prior as posteriors; rows keep their
multiplicity; domains without labelled rows have no posterior, and the others share what they don't get, in proportion;
labelled rows of other domains, null labels and null ids teach nothing; with no labelled row at all posteriors are equal
over the domains. Columns of the documents keep their values, whatever their names; but for ``rate``, which is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.shared import bounded_rows, fresh, stored

BUCKETS = 4096
#: Characters that end a word, beside the space.
_BREAKS = "\t\n\v\f\r!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"


def word_buckets(text: Column) -> Column:
    """Hashes of the lower-case words of a text, runs without white space, digits and ASCII punctuation."""
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), _BREAKS, " " * len(_BREAKS))
    return F.transform(F.array_remove(F.split(plain, " "), ""), lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def n_tokens(text: Column) -> Column:
    """White-space-separated tokens. Only texts with two spaces in a row need a pattern."""
    plain = F.coalesce(text, F.lit(""))
    for c in "\n\r\t\f\v":
        plain = F.replace(plain, F.lit(c), F.lit(" "))
    plain = F.trim(plain)
    single = F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(" "), F.lit(""))) + 1
    return F.when(plain == "", 0).when(F.instr(plain, "  ") == 0, single).otherwise(F.size(F.split(plain, " +"))).cast("long")


def _literal(values: list[float]) -> Column:
    """An array as one literal, which costs the same to plan for any length."""
    return F.split(F.lit(",".join(f"{x:.6g}" for x in values)), ",").cast("array<double>")


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


@dataclass
class Domains:
    """Classifier: per domain, its prior and the log probability of each bucket of words, less its mean over domains."""

    names: list[str]
    prior: list[float]
    weights: list[list[float]]
    scale: float = 1.0
    power: float = 0.0
    #: One entry per gradient step: (E_k - T_k) / N_k of each domain.
    steps: list[list[float]] = field(default_factory=list)
    converged: bool = False
    #: (E_k - T_k) / T_k after the last step.
    residual: list[float] = field(default_factory=list)

    def evidence(self, docs: DataFrame, n: str, columns: list[str]) -> DataFrame:
        """Adds the number of words and, for each domain, the summed weights of the words."""
        found = fresh([*docs.columns, n, *columns], "buckets")
        docs = docs.withColumn(found, word_buckets(F.col("text")))
        total = lambda w: F.aggregate(found, F.lit(0.0), lambda x, k: x + F.get(_literal(w), k))
        return docs.withColumns({n: F.size(found)} | {c: total(w) for c, w in zip(columns, self.weights, strict=True)}).drop(found)

    def with_posteriors(self, docs: DataFrame, column: str) -> DataFrame:
        """Adds an array of posteriors, in the order of ``names``."""
        if not self.weights:
            return docs.withColumn(column, F.array(*map(F.lit, self.prior)))
        n, top = fresh([*docs.columns, column], "n"), fresh([*docs.columns, column], "top")
        logits = [fresh([*docs.columns, column], f"logit{k}") for k in range(len(self.names))]
        found = self.evidence(docs, n, logits)
        scale = F.lit(self.scale) * F.pow(F.greatest(F.col(n), F.lit(1)).cast("double"), F.lit(-self.power))
        found = found.withColumns({c: F.col(c) * scale + math.log(p) for c, p in zip(logits, self.prior, strict=True)}).drop(n)
        found = found.withColumn(top, F.greatest(*logits) if len(logits) > 1 else F.col(logits[0]))
        found = found.withColumns({c: F.exp(F.col(c) - F.col(top)) for c in logits})
        return found.withColumn(column, F.array(*(F.col(c) / _sum([F.col(x) for x in logits]) for c in logits))).drop(*logits, top)

    def rate(self, posteriors: str) -> Column:
        """The rate after all steps. The steps are one literal, so the expression has the same size for any number."""
        steps = F.array(*(F.array(*map(F.lit, step)) for step in self.steps)) if self.steps else F.array().cast("array<array<double>>")
        part = lambda step: _sum([F.get(posteriors, F.lit(k)) * F.get(step, F.lit(k)) for k in range(len(self.names))])
        return F.aggregate(steps, F.lit(1.0), lambda r, step: F.greatest(r - part(step), F.lit(0.0)))


def fit_domains(docs: DataFrame, labelled: DataFrame, domains: list[str], max_fit_rows: int = 20_000) -> Domains:
    """``labelled``: (doc_id, domain); an id with two domains teaches both. A fifth of the rows, by hash of the id,
    calibrates."""
    place = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = labelled.filter(F.col("doc_id").isNotNull() & F.col("domain").isin(domains)).distinct().orderBy(place, "domain").limit(max_fit_rows)
    rows = stored(bounded_rows(docs, chosen, max_fit_rows).select("domain", "text", (F.pmod(place, F.lit(5)) == 0).alias("apart")), "labelled")
    sizes = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    names = [d for d in domains if d in sizes]
    if not names:
        return Domains(list(domains), [1 / len(domains)] * len(domains), [])
    prior = [sizes[d] / sum(sizes.values()) for d in names]
    fitted, apart = rows.filter("not apart"), rows.filter("apart")
    if not fitted.limit(1).count() or not apart.limit(1).count():
        fitted = apart = rows
    counts = [[1.0] * BUCKETS for _ in names]
    for r in fitted.select("domain", F.explode(word_buckets(F.col("text"))).alias("bucket")).groupBy("domain", "bucket").count().collect():
        counts[names.index(r["domain"])][r["bucket"]] += r["count"]
    logs = [[math.log(c / sum(row)) for c in row] for row in counts]
    means = [sum(x) / len(names) for x in zip(*logs, strict=True)]
    model = Domains(names, prior, [[x - m for x, m in zip(row, means, strict=True)] for row in logs])
    model.scale, model.power = _calibrated(model, apart)
    return model


def _calibrated(model: Domains, rows: DataFrame) -> tuple[float, float]:
    """The scale and power of least log loss of the domains of ``rows``."""
    logits = [f"s{k}" for k in range(len(model.names))]
    grid = F.array(*(F.struct(F.lit(2.0 ** (j / 2)).alias("scale"), F.lit(power).alias("power")) for j in range(-14, 7) for power in (0.0, 0.25, 0.5, 0.75)))
    found = model.evidence(rows, "n", logits).select("domain", "n", *logits, F.explode(grid).alias("g"))
    scaled = [F.col(c) * F.col("g.scale") * F.pow(F.greatest("n", F.lit(1)).cast("double"), -F.col("g.power")) + math.log(p) for c, p in zip(logits, model.prior, strict=True)]
    found = found.select("domain", "g", *(x.alias(c) for x, c in zip(scaled, logits, strict=True)))
    top = F.greatest(*logits) if len(logits) > 1 else F.col(logits[0])
    own = F.coalesce(*(F.when(F.col("domain") == d, F.col(c)) for d, c in zip(model.names, logits, strict=True)))
    loss = F.log(_sum([F.exp(F.col(c) - top) for c in logits])) + top - own
    best = found.groupBy("g").agg(F.round(F.avg(loss), 9).alias("loss")).orderBy("loss", "g.power", "g.scale").first()
    return best["g"]["scale"], best["g"]["power"]


def fit_rates(soft: DataFrame, model: Domains, targets: dict[str, float], tolerance: float = 1e-7, max_steps: int = 100) -> Domains:
    """Append to ``model`` the steps that bring ``soft(n_tokens, p)`` to ``targets``, weights of its domains."""
    k = range(len(model.names))
    expected = lambda rate: soft.agg(*(F.coalesce(F.sum(rate * F.col("n_tokens") * F.get("p", F.lit(i))), F.lit(0.0)).alias(f"e{i}") for i in k)).first()
    base = list(expected(F.lit(1.0)))
    share = sum(targets.get(d, 0) for d in model.names)
    goal = [sum(base) * targets.get(d, 0) / share if share else base[i] for i, d in enumerate(model.names)]
    now, moved = base, math.inf
    while moved >= tolerance and len(model.steps) < max_steps:
        model.steps.append([(now[i] - goal[i]) / base[i] if base[i] else 0.0 for i in k])
        before, now = now, list(expected(model.rate("p")))
        moved = max(abs(now[i] - before[i]) / base[i] if base[i] else 0.0 for i in k)
    model.converged = moved < tolerance
    model.residual = [(now[i] - goal[i]) / goal[i] if goal[i] else now[i] / max(sum(base), 1e-9) for i in k]
    return model


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The domain of each labelled document: its language."""
    return docs.join(labels.filter("quality is not null").select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", F.col("lang").alias("domain"))


def mixture(docs: DataFrame, labels: DataFrame, targets: dict[str, float], max_fit_rows: int = 20_000) -> tuple[DataFrame, Domains]:
    """``(doc_id, n_tokens, p, rate)`` for each row, and the model whose rates bring language domains to ``targets``."""
    model = fit_domains(docs, _labelled(docs, labels), list(targets), max_fit_rows)
    soft = stored(model.with_posteriors(docs.select("doc_id", "text"), "p").select("doc_id", n_tokens(F.col("text")).alias("n_tokens"), "p").hint("rebalance"), "posteriors")
    model = fit_rates(soft, model, targets)
    return soft.withColumn("rate", model.rate("p")), model


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float], max_fit_rows: int = 20_000) -> DataFrame:
    """``docs`` with ``rate`` (a column of that name is replaced); documents of rate 0 go.

    They go by an empty array, as a filter on the rate would be pushed below the expressions it is made of, and these
    computed again for each of its terms."""
    _, model = mixture(docs, labels, targets, max_fit_rows)
    columns = [c for c in docs.columns if c != "rate"]
    p = fresh(columns, "p")
    found = model.with_posteriors(docs.select(*columns), p)
    rate = F.filter(F.array(model.rate(p)), lambda r: r > 0)
    return found.select(*columns, F.explode(rate).alias("rate"))
