"""Mixing to target weights with soft domain membership.

A classifier trained on a labelled table (hashed words, multinomial logistic
regression of Spark ML) gives every document a posterior over the domains.
Document rates r >= 0 are then fitted so that the expected tokens of every
domain, ``sum(rate * tokens * posterior)``, match the targets: least squares,
by projected gradient from all rates at 1, in the metric of the documents'
tokens.  Projection is lazy: the steps add up to one vector over the domains,
and a rate is 1 less the document's posterior times that vector, clipped at
zero, so it depends on nothing else, however many steps there were.  A step is
the residual times the inverse of the domains' Gram matrix over the documents
whose rate is not clipped, exact while no further rate clips.  Several lengths
are tried in one pass, and the one that leaves the least residual is taken.  An
iteration is two aggregations of a few numbers per pair of domains.

The fit ends when the targets are reached.  Targets that are not reached (all
tokens in one domain, say, while every document also holds some of another)
raise an error that tells what was aimed at and what was reached.  Every domain
is learned; more than ``MAX_DOMAINS`` raise an error.

Everything on the way is DataFrame functions and Spark ML; there is no Python
on the executors.

Defined cases: a null or empty text has no tokens, gets the posterior of no
words, and its rate does not matter to the fit; null labels and null ids are
not learned from; repeated rows get equal rates and equal copies; a target for
a domain without any document cannot be met and is left out; without labelled
rows all documents are of one domain; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesweft.llm.columns import spread, words
from salesweft.session import written

FEATURES = 1 << 14
MAX_ROWS = 8000
MAX_DOMAINS = 64
ITERATIONS = 60
TOLERANCE = 1e-4
LENGTHS = (16.0, 4.0, 1.0, 0.5, 0.25, 0.06, 0.015)
PRE = "__mix_"


@dataclass(frozen=True)
class Rates:
    """The fitted rates: the sum of the steps, and expected tokens before, aimed at and reached."""

    domains: list[str]
    moved: list[float]
    steps: int
    before: list[float]
    targets: list[float]
    reached: list[float]


def label_domains(labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, domain) of a table of quality and toxic marks: clean, low or toxic."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean").when(F.col("quality") == 0, "low")
    return labels.select(F.col(id_column).alias("id"), domain.alias("domain")).where("id IS NOT NULL AND domain IS NOT NULL")


def _terms(text: Column) -> Column:
    return words(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"([^a-z0-9\x20\x09-\x0D\x80-\x{10FFFF}]+)", " $1 "))


def train(docs: DataFrame, labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_rows: int = MAX_ROWS) -> tuple[list[str], PipelineModel | None]:
    """Domains in order and the model, from at most about ``max_rows`` labelled rows."""
    known = labelled.groupBy("id").agg(F.min("domain").alias("domain"))
    counts = known.groupBy("domain").count().limit(MAX_DOMAINS + 1).collect()
    if len(counts) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains: a pass sums the pairs of all of them")
    domains = sorted(r["domain"] for r in counts)
    if len(domains) < 2:
        return domains or ["all"], None
    rate = max_rows / sum(r["count"] for r in counts)
    number = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain")) - 1
    sample = (
        docs.where(spread(F.lit(5), F.col(id_column)) < rate).select(F.col(id_column).alias("id"), F.col(text_column).alias("t"))
        .join(known.where(spread(F.lit(5), F.col("id")) < rate), "id").where(number >= 0)
        .select(number.cast("double").alias(f"{PRE}label"), _terms(F.col("t")).alias(f"{PRE}terms"))
    )
    stages = [
        HashingTF(inputCol=f"{PRE}terms", outputCol=f"{PRE}counts", numFeatures=FEATURES),
        Normalizer(inputCol=f"{PRE}counts", outputCol=f"{PRE}features", p=2.0),
    ]
    ready = written(PipelineModel(stages).transform(sample).select(f"{PRE}label", f"{PRE}features"), "mixing-sample")
    found = [r[0] for r in ready.select(f"{PRE}label").distinct().collect()]
    if len(found) < 2:
        return domains[:1], None
    model = LogisticRegression(labelCol=f"{PRE}label", featuresCol=f"{PRE}features", predictionCol=f"{PRE}prediction", rawPredictionCol=f"{PRE}raw", probabilityCol=f"{PRE}probability", family="multinomial", maxIter=40, regParam=1e-4).fit(ready)
    return domains[: model.numClasses], PipelineModel([*stages, model])


def with_posteriors(docs: DataFrame, domains: list[str], model: PipelineModel | None, keep: list[str], text_column: str = "text") -> DataFrame:
    """The columns to keep, the tokens and one posterior column per domain, as a written table."""
    scored = docs.withColumn(f"{PRE}terms", _terms(F.col(text_column)))
    posteriors = [F.lit(1.0).alias(f"{PRE}p0")]
    if model is not None:
        scored = model.transform(scored).withColumn(f"{PRE}p", vector_to_array(f"{PRE}probability"))
        posteriors = [F.col(f"{PRE}p")[i].alias(f"{PRE}p{i}") for i in range(len(domains))]
    tokens = F.size(words(F.col(text_column))).cast("long").alias(f"{PRE}tokens")
    return written(scored.select(*keep, tokens, *posteriors), "mixing-posteriors")


def _rate(moved: list[float]) -> Column:
    move = sum((F.col(f"{PRE}p{i}") * F.lit(float(y)) for i, y in enumerate(moved)), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.lit(1.0) - move)


def fit_rates(posteriors: DataFrame, domains: list[str], targets: dict[str, float], anchor: str | None = None) -> Rates:
    """Rates whose expected domain tokens match the target weights.

    The targets add up to all tokens.  With an ``anchor`` that domain keeps
    its tokens, and the others get their weight in proportion to it, but not
    more than they have.
    """
    n = len(domains)
    p = [F.col(f"{PRE}p{i}") for i in range(n)]
    tokens = F.col(f"{PRE}tokens")
    pairs = [(i, j) for i in range(n) for j in range(i, n)]

    def sums(*values: Column) -> np.ndarray:
        return np.array([float(x or 0.0) for x in posteriors.agg(*[F.sum(v) for v in values]).first()])

    def reach(moved: np.ndarray) -> list[Column]:
        return [tokens * x * _rate(moved) for x in p]

    def gram_at(moved: np.ndarray) -> np.ndarray:
        """Over the documents that count."""
        counted = F.when(_rate(moved) > 0, tokens)
        gram = np.zeros((n, n))
        for (i, j), x in zip(pairs, sums(*[counted * p[i] * p[j] for i, j in pairs])):
            gram[i, j] = gram[j, i] = x
        return gram

    before = sums(*[tokens * x for x in p])
    weights = np.array([max(0.0, targets.get(d, 0.0)) for d in domains]) * (before > 0)
    goal = before * 0
    if anchor in domains and weights[domains.index(anchor)] > 0:
        at = domains.index(anchor)
        goal = np.minimum(before, before[at] * weights / weights[at])
    elif weights.sum() > 0:
        goal = before.sum() * weights / weights.sum()
    moved, reached = np.zeros(n), before
    gram = metric = None
    for step in range(ITERATIONS):
        if np.abs(reached - goal).max() <= TOLERANCE * max(1.0, goal.sum()):
            return Rates(domains, moved.tolist(), step, before.tolist(), goal.tolist(), reached.tolist())
        gram = gram_at(moved)
        metric = np.linalg.pinv(gram, rcond=1e-9, hermitian=True) if metric is None else metric
        towards = np.linalg.pinv(gram, rcond=1e-12, hermitian=True) @ (reached - goal)
        tried = [moved + length * towards for length in LENGTHS]
        ends = sums(*[c for t in tried for c in reach(t)]).reshape(len(tried), n)
        best = min(range(len(tried)), key=lambda k: float((ends[k] - goal) @ metric @ (ends[k] - goal)))
        moved, reached = tried[best], ends[best]
    raise RuntimeError(f"no rates reach the targets: {domains}, aimed at {goal.tolist()}, reached {reached.tolist()}")


def _copies(rate: Column, id_column: str, text_column: str) -> Column:
    return F.floor(rate + spread(F.lit(6), F.col(id_column), F.col(text_column))).cast("long")


def mixing_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, domain (likeliest), posteriors, rate and copies."""
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    domains, model = train(narrow, labelled)
    hashed = narrow.withColumn("h", F.xxhash64("text"))
    table = with_posteriors(hashed, domains, model, ["doc_id", "h"])
    rate = _rate(fit_rates(table, domains, targets).moved)
    posteriors = F.array(*[F.col(f"{PRE}p{i}") for i in range(len(domains))])
    return table.select(
        "doc_id",
        F.col(f"{PRE}tokens").alias("n_tokens"),
        F.get(F.array(*[F.lit(d) for d in domains]), (F.array_position(posteriors, F.array_max(posteriors)) - 1).cast("int")).alias("domain"),
        posteriors.alias("posteriors"),
        rate.alias("rate"),
        _copies(rate, "doc_id", "h").alias("copies"),
    )


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], anchor: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents at their rates, with all their columns: a rate of 0.3 keeps three in ten, a rate of 2 doubles."""
    domains, model = train(docs, labelled, id_column, text_column)
    table = with_posteriors(docs, domains, model, docs.columns, text_column)
    rate = _rate(fit_rates(table, domains, targets, anchor).moved)
    copies = table.withColumn(f"{PRE}copies", _copies(rate, id_column, text_column)).where(F.col(f"{PRE}copies") > 0)
    return copies.withColumn(f"{PRE}copy", F.explode(F.sequence(F.lit(1), F.col(f"{PRE}copies").cast("int")))).select(*docs.columns)
