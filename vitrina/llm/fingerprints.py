"""Document fingerprints (DataFrame functions only): bottom-k sketches of hashed 5-word shingles.

A sketch is the sorted array of the k smallest distinct 64-bit shingle hashes. The sketch of a union is the bottom k
of two sketches (``merge``), so parts of a document or of a corpus can be sketched apart; resemblance, containment and
the number of distinct shingles are estimated from sketches alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.common import KEY, doc_id, documents, one_row_per_document, positions, words
from vitrina.operators.surrogate import dense_index

K = 128
#: Ids that share id div this are put in order together: at most so many documents of a window.
BLOCK = 256


def with_sketch(df: DataFrame, text: str, name: str, k: int = K, width: int = 5) -> DataFrame:
    """Add the sketch of column ``text``. Words are lower-cased; a text of fewer words than ``width`` has its whole
    sequence as one shingle, one without words an empty sketch (as has null)."""
    keep = [F.col(c) for c in df.columns]
    d = df.select(*keep, F.transform(words(F.lower(F.coalesce(F.col(text), F.lit("")))),
                                     lambda w: F.xxhash64(w)).alias("_h"))
    shingle = lambda i: F.xxhash64(*[F.get("_h", i + j) for j in range(width)])
    short = F.aggregate("_h", F.lit(0).cast("long"), lambda acc, h: F.xxhash64(acc, h))
    all_ = (F.when(F.size("_h") == 0, F.array().cast("array<bigint>"))
            .when(F.size("_h") < width, F.array(short))
            .otherwise(F.transform(positions(F.size("_h") - (width - 1)), shingle)))
    d = d.select(*keep, all_.alias("_s"))
    return d.select(*keep, F.slice(F.sort_array(F.array_distinct("_s")), 1, k).alias(name))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness, 0 to 1; 1 for two empty sketches."""
    u = merge(a, b, k)
    both = F.size(F.array_intersect(u, F.array_intersect(a, b)))
    return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(both / F.size(u)).cast("double")


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) / share of the hash range below the k-th."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    r = resemblance(a, b, k)
    union = distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), r * union / distinct_count(a, k)))


def as_text(a: Column) -> Column:
    """The sketch as base64 of its big-endian hashes; equal sketches give equal strings."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")))


def with_next(docs: DataFrame, k: int = K) -> DataFrame:
    """(_doc, text, sketch, next_text, next_sketch) where next is the document with the next smaller id, and the
    largest after the smallest.

    Ids are put in order within blocks of BLOCK consecutive ids, so a window never holds more than BLOCK documents and
    whole texts are shuffled once. Only the largest and the smallest document of each block meet across blocks; the
    blocks that exist are chained by their dense index.
    """
    d = docs.select(KEY, F.coalesce("text", F.lit("")).alias("text"),
                    F.shiftright(KEY, BLOCK.bit_length() - 1).alias("block"))
    inside = Window.partitionBy("block").orderBy(F.desc(KEY))
    own = with_sketch(d.repartition("block"), "text", "sketch", k)
    own = own.select("*", F.lead(F.struct("text", "sketch")).over(inside).alias("next"))
    own = own.where(F.col("next").isNotNull()).select(KEY, "text", "sketch", F.col("next.text").alias("next_text"),
                                                      F.col("next.sketch").alias("next_sketch"))
    up = Window.partitionBy("block").orderBy(KEY)
    heads = with_sketch(d.withColumn("rn", F.row_number().over(inside)).where("rn = 1").drop("rn"), "text", "next_sketch", k)
    tails = with_sketch(d.withColumn("rn", F.row_number().over(up)).where("rn = 1").drop("rn"), "text", "sketch", k)
    order = dense_index(d.select("block").distinct(), ["block"], "nth")
    last = order.agg(F.max("nth")).first()[0]
    # block with index i is followed by i - 1; the first one by the last
    links = (order.select("block", F.when(F.col("nth") == 1, F.lit(last)).otherwise(F.col("nth") - 1).alias("nth"))
             .join(order.select("nth", F.col("block").alias("next_block")), "nth").drop("nth"))
    heads = heads.select(F.col("block").alias("next_block"), F.col("text").alias("next_text"), "next_sketch")
    edges = tails.join(links, "block").join(heads, "next_block").select(KEY, "text", "sketch", "next_text", "next_sketch")
    return own.unionByName(edges)


def op10_fingerprints(spark, sf_dir):
    """Fingerprints of ``documents`` and of their edited texts. One row per doc_id; null text as empty; a table of one
    document has itself as next. n_shingles, n_shingles_next and containment are estimates from the sketches."""
    d = with_next(one_row_per_document(documents(spark, sf_dir)))
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    d = d.select(KEY, "sketch", "next_sketch", n.cast("long").alias("n_chars"),
                 F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)).alias("edited"))
    d = with_sketch(d, "edited", "edited_sketch")
    return d.select(doc_id(), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                    resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                    resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
                    distinct_count(F.col("sketch")).alias("n_shingles"),
                    containment(F.col("sketch"), F.col("edited_sketch")).alias("contained_in_edited"))
