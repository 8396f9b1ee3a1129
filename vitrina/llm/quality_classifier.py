"""Quality classifier: hierarchical empirical Bayes over documents, paths and hosts.

A document classifier gives each text's odds of being good. Rates of hosts and of paths inside hosts are grouped sums
of that evidence, shrunk: a host towards the global rate, a path towards its host, by Beta priors whose strength comes
from the spread of the rates (method of moments). A document's posterior odds are its own odds times the odds of its
path, without this document's own part, over the global odds. Sparse sites thus stay near the global prior. For
``documents`` the host is the source and the path is the language section of the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import KEY, doc_id, documents, one_row_per_document, stored
from vitrina.llm.text_classifier import fitted, scored
from vitrina.sources.tables import read_table

GOOD, BAD = "good", "bad"
EDGE = 1e-4


def _clip(p: Column) -> Column:
    return F.least(F.lit(1 - EDGE), F.greatest(F.lit(EDGE), p))


def _logit(p: Column) -> Column:
    return F.log(_clip(p) / (1 - _clip(p)))


def _strength(groups: DataFrame, mean: Column) -> float:
    """The Beta prior strength that explains the spread of the groups' rates ``s / n`` about ``mean``.

    Variance between groups is what their spread exceeds sampling by; strength is between 1 (rates differ freely) and
    10,000 (all alike)."""
    g = groups.select("n", (F.col("s") / F.col("n")).alias("r"), mean.alias("m"))
    v = g.agg(F.sum(F.col("n") * (F.col("r") - F.col("m")) ** 2).alias("spread"), F.sum("n").alias("n"),
              F.sum(F.col("m") * (1 - F.col("m"))).alias("chance"),
              F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("most")).first()
    if not v["n"] or v["spread"] <= v["chance"]:
        return 10_000.0
    return min(10_000.0, max(1.0, v["most"] / (v["spread"] - v["chance"]) - 1))


def quality_posteriors(evidence: DataFrame) -> DataFrame:
    """(_doc, p_document, p_host, p_path, quality) of (_doc, host, path, p).

    Sums are map-side combined; hosts and paths come back to documents by a join that adaptive execution splits for a
    hot host. Three numbers come to the driver: the global rate and the two strengths.
    """
    paths = stored(evidence.groupBy("host", "path").agg(F.sum("p").alias("s"), F.count(F.lit(1)).cast("double").alias("n")),
                   "paths")
    hosts = paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    total = hosts.agg((F.sum("s") / F.sum("n")).alias("mean")).first()["mean"]
    mean = F.lit(0.5 if total is None else total)
    k = _strength(hosts, mean)
    hosts = hosts.select("host", ((F.col("s") + k * mean) / (F.col("n") + k)).alias("p_host"))
    paths = paths.join(hosts, "host")
    k = _strength(paths, F.col("p_host"))
    d = evidence.join(paths, ["host", "path"])
    rest = (F.col("s") - F.col("p") + k * F.col("p_host")) / (F.col("n") - 1 + k)
    odds = _logit(F.col("p")) + _logit(rest) - _logit(mean)
    return d.select(KEY, F.col("p").alias("p_document"), "p_host", rest.alias("p_path"), (1 / (1 + F.exp(-odds))).alias("quality"))


def op5_quality_classifier(spark, sf_dir):
    """Quality of every document of ``documents``, learned from ``labels``; one row per doc_id.

    Null text is scored as empty. Null source or lang: a site without a name. Without labels all documents have the
    same evidence. ``kept``: quality of one half or more.
    """
    docs = documents(spark, sf_dir)
    labels = read_table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, GOOD).when(F.col("quality") == 0, BAD).alias("class"))
    model = fitted(docs, labels, [BAD, GOOD])
    d = one_row_per_document(docs, "source", "lang")
    site = d.select(KEY, F.coalesce("source", F.lit("")).alias("host"), F.coalesce("lang", F.lit("")).alias("path"), "text")
    # site names ride along with the text, so no join brings them back
    evidence = scored(site, model, "host", "path").select(KEY, "host", "path", F.get("posterior", F.lit(1)).alias("p"))
    evidence = stored(evidence, "evidence")
    q = quality_posteriors(evidence)
    return q.select(doc_id(), "p_document", "p_host", "p_path", "quality", (F.col("quality") >= 0.5).alias("kept"))
