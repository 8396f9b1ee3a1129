"""Mixing sources to target weights with soft membership.

A classifier fitted on a labelled table gives each document posterior probabilities p[k] of the domains. Document rates
r >= 0 are then fitted by projected-gradient least squares, so that the expected tokens of each domain, the sum of
r * words * p[k] over all documents, meet the targets: r starts at 1, and each step takes

    r <- max(0, r - p . u),   u = G^-1 e,   e = expected - target,   G = sum over r > 0 of words * p p^T

which is the gradient of 1/2 |e|^2 scaled by the domains' own curvature, so that a few steps are enough. A step needs
one distributed aggregate of domains * (domains + 1) sums over (words, p); rates are an expression of p and the steps so
far, never a collected or rewritten table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import KEY, doc_id, documents, one_row_per_document, stored
from vitrina.llm.text_classifier import fitted, scored
from vitrina.sources.tables import read_table

#: Domains of ``labels`` and the weights of their tokens in the mixture.
TARGETS = {"good": 0.90, "poor": 0.08, "toxic": 0.02}
#: Tokens of the mixture, over those it would have if the first domain kept all its tokens and no more.
BUDGET = 1.05
STEPS, CLOSE = 20, 1e-6
#: Folds in which labels are judged by the other folds, before any is learned from.
FOLDS = 5


def domain_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, class) of ``labels``: toxic, else by quality; no class where both are null."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good")
                         .when(F.col("quality") == 0, "poor").alias("class"))


def rate_after(steps: list[np.ndarray], p: list[Column]) -> Column:
    """The rate of a document with posteriors ``p`` after the steps."""
    r = F.lit(1.0)
    for u in steps:
        r = F.greatest(F.lit(0.0), r - sum((pk * float(uk) for pk, uk in zip(p[1:], u[1:])), p[0] * float(u[0])))
    return r


def fit_rates(membership: DataFrame, targets: dict[str, float], budget: float = BUDGET) -> list[np.ndarray]:
    """The steps that bring (words, posterior) to the targets; [] for an empty table. ``posterior`` is in the order of
    ``targets``. Domains that no document can have are left out of account."""
    k = len(targets)
    weights = np.array(list(targets.values()), float)
    weights /= weights.sum()
    p = [F.get("posterior", F.lit(i)) for i in range(k)]
    steps: list[np.ndarray] = []
    scale, best, target = 1.0, np.inf, None
    last = np.zeros(k)
    for _ in range(STEPS):
        r = rate_after(steps, p)
        live = F.when(r > 0, F.col("words").cast("double")).otherwise(0.0)
        sums = [F.sum(F.col("words") * r * a) for a in p] + [F.sum(live * p[i] * p[j]) for i in range(k) for j in range(i, k)]
        got = membership.agg(*[F.coalesce(s, F.lit(0.0)).alias(f"s{i}") for i, s in enumerate(sums)]).first()
        have = np.array(got[:k])
        if not have.sum():
            return steps
        if target is None:
            target = budget * have[0] / weights[0] * weights if have[0] else have.sum() * weights
        e = have - target
        size = np.abs(e).max() / target.sum()
        if size >= best:  # rates ran into 0: half the step
            steps.pop()
            scale /= 2
            if scale < 0.05:
                return steps
            steps.append(scale * last)
            continue
        best = size
        if size < CLOSE:
            return steps
        g = np.zeros((k, k))
        g[np.triu_indices(k)] = got[k:]
        g = g + np.triu(g, 1).T
        last = np.linalg.solve(g + 1e-9 * np.trace(g) * np.eye(k), e)
        scale = min(1.0, 2 * scale)
        steps.append(scale * last)
    return steps


def mixed(docs: DataFrame, texts: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, budget: float = BUDGET) -> DataFrame:
    """(_doc, words, posterior, rate, copies) of (_doc, text) with unique ids.

    Learned from ``texts`` (doc_id, text) with ``labels`` (doc_id, class), without labels that the others contradict: a
    class that is put on documents of other classes as well leaves each document some of its mass, which no choice of
    documents brings to a lower target, and the rates then follow the noise. ``copies`` is the rate rounded up or down with the rate's
    fraction as the probability, by a hash of the id: the same for each run, and right in expectation. A text without
    words has no tokens; its rate follows its posteriors like any other's.
    """
    targets = targets or TARGETS
    model = fitted(texts, labels, list(targets), folds=FOLDS)
    membership = stored(scored(docs, model), "membership")
    steps = fit_rates(membership, targets, budget)
    rate = rate_after(steps, [F.get("posterior", F.lit(i)) for i in range(len(targets))])
    chance = F.pmod(F.xxhash64(F.lit("copies"), KEY), F.lit(1 << 30)) / float(1 << 30)
    return (membership.withColumn("rate", rate).withColumn("copies", F.floor(F.col("rate") + chance).cast("long"))
            .select(KEY, "words", "posterior", "rate", "copies"))


def op8_mixing(spark, sf_dir):
    """Rates that bring ``documents`` to TARGETS, learned from ``labels``; one row per doc_id. Null text: as empty."""
    docs = documents(spark, sf_dir)
    labels = domain_labels(read_table(spark, sf_dir, "labels"))
    d = mixed(one_row_per_document(docs), docs, labels)
    names = [F.get("posterior", F.lit(i)).alias(f"p_{name}") for i, name in enumerate(TARGETS)]
    return d.select(doc_id(), F.col("words").alias("n_tokens"), *names, "rate", "copies")
