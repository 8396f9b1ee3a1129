"""The corpus pipeline: STAGES applied to ``documents``, each stage's result written and read again for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm.common import KEY, documents, keyed_rows, stored
from vitrina.llm.language_id import UNKNOWN, fitted, predicted
from vitrina.llm.line_dedup import drop_shared_lines
from vitrina.llm.mixing import domain_labels, mixed
from vitrina.llm.near_dedup import near_duplicates
from vitrina.llm.sentencepiece_codec import encode_column, load_codec
from vitrina.session import ship_package
from vitrina.sources.tables import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: How far from undecided to sure a text's score must lie, or it is taken for none of the languages.
LEAST_SHARE = 0.25
#: Percent of common shingles from which documents are near-duplicates.
ALIKE = 80


def _keyed(docs: DataFrame) -> DataFrame:
    """The columns of documents with a key ``_doc`` for each row: rows that share an id, or have none, are documents
    of their own."""
    return keyed_rows(docs, *COLUMNS[1:])


def _columns(d: DataFrame) -> DataFrame:
    return d.select(COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows, with that language as ``lang``. Text without a letter goes, and
    text whose score is less than LEAST_SHARE of the way from undecided to sure: other languages, letter junk, and some
    texts of a few characters."""
    ship_package(spark)
    d = _keyed(docs)
    model = fitted(docs)
    found = predicted(d, model, "doc_id", "text", "source", "n_chars")
    found = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= model.least_score(LEAST_SHARE)))
    return _columns(found.withColumnRenamed("lang_pred", "lang"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others keep; a document that loses all its text goes. ``n_chars`` follows."""
    ship_package(spark)
    d = _keyed(docs)
    kept = drop_shared_lines(d.select(KEY, "text")).where((F.col("n_dropped") == 0) | (F.trim("kept") != ""))
    d = d.drop("text", "n_chars").join(kept.select(KEY, F.col("kept").alias("text")), KEY)
    return _columns(d.withColumn("n_chars", F.length("text").cast("long")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id (the first row of that id) of each group of near-duplicates, linked at a likeness of ALIKE percent."""
    ship_package(spark)
    d = _keyed(docs)
    groups = near_duplicates(d.select(KEY, "text"), ALIKE)
    return _columns(d.join(groups.where(F.col(KEY) == F.col("component")).select(KEY), KEY, "left_semi"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says; repeated documents keep their id."""
    ship_package(spark)
    d = _keyed(docs)
    m = mixed(d.select(KEY, "text"), docs, domain_labels(read_table(spark, sf_dir, "labels")))
    d = d.join(m.where("copies > 0").select(KEY, "copies"), KEY)
    return _columns(d.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, as checked by decoding and against the sentencepiece library."""
    ship_package(spark)
    return encode_column(docs.select(COLUMNS), load_codec())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]

#: The fitted classifiers and the token ids are beyond SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    d = documents(spark, sf_dir)
    for at, (name, stage) in enumerate(STAGES):
        d = stage(spark, d, sf_dir)
        if at < len(STAGES) - 1:
            d = stored(d, name)
    return d
