"""Quality rules on cross-document line frequency (DataFrame functions only).

Normalised lines are hashed, distinct documents are counted per (host, line), lines above the limit are boilerplate
and leave their documents, whose remaining text is put together from the other lines; a document that keeps less than half
of its words is depleted and rejected. The host of
``documents`` is its source. Exact copies of a text count once, so that a page fetched a thousand times does not turn
its own lines into boilerplate. Counts are map-side combined; a line that a third of all documents hold is split by
adaptive execution in the join with the (single-row) common lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import KEY, WHITE, WHITE_RUN, doc_id, documents, one_row_per_document, positions, words

# Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"


def text_counts(docs: DataFrame) -> DataFrame:
    """(_doc, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of (_doc, text); null text is empty.

    A word of a 3-word window that occurs twice or more counts as repeated, in its first occurrence too: windows are
    hashed and sorted together with their positions, neighbours with equal hashes are repeats.
    """
    d = docs.select(KEY, F.coalesce("text", F.lit("")).alias("text"))
    has_word = f"[^{WHITE_RUN[1:-2]}]"
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(has_word))
    d = d.select(KEY, "text", words(F.col("text")).alias("w"), lines.alias("lines"),
                 F.length(F.regexp_replace("text", f"[^{SYMBOLS}]++", "")).cast("long").alias("n_symbols"))
    d = d.select(KEY, "text", F.length(F.array_join("w", "")).cast("long").alias("word_chars"), "n_symbols", F.size("w").cast("long").alias("n_words"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    window = lambda i: F.struct(F.xxhash64(F.get("h", i), F.get("h", i + 1), F.get("h", i + 2)).alias("h"), i.alias("i"))
    d = d.withColumn("s", F.sort_array(F.transform(positions(F.size("h") - 2), window)))
    same = lambda j: (F.get("s", j)["h"] == F.get("s", j - 1)["h"]) | (F.get("s", j)["h"] == F.get("s", j + 1)["h"])
    found = F.filter(F.transform("s", lambda x, j: F.when(same(j), x["i"])), lambda i: i.isNotNull())
    d = d.withColumn("found", found).drop("s", "h")
    covered = F.array_distinct(F.flatten(F.transform("found", lambda i: F.array(i, i + 1, i + 2))))
    return d.select(KEY, "text", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    F.size(covered).cast("long").alias("n_repeat_words"))


def _normalised(line: Column) -> Column:
    return F.lower(F.btrim(line, F.lit(WHITE)))


def common_lines(docs: DataFrame, min_docs: int) -> DataFrame:
    """(line) hashes of host and normalised line for the lines in more than ``min_docs`` distinct documents of a host,
    however many documents it has. Equal texts of one host are one document."""
    lines = F.array_distinct(F.transform(F.split("text", "\n"), lambda x: F.xxhash64("host", _normalised(x))))
    once = docs.select(F.explode(lines).alias("line"), F.xxhash64("text").alias("copy")).distinct()
    return once.groupBy("line").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > min_docs).select("line")


def boilerplate_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """(_doc, drop, n_lines_removed, n_words_removed) of the documents that lose lines; ``drop``: their positions."""
    d = docs.select(KEY, F.coalesce("source", F.lit("")).alias("host"), F.coalesce("text", F.lit("")).alias("text"))
    rows = (d.select(KEY, "host", F.posexplode(F.split("text", "\n")).alias("at", "x"))
            .select(KEY, "at", F.xxhash64("host", _normalised(F.col("x"))).alias("line"),
                    F.size(words(F.col("x"))).cast("long").alias("n")).where("n > 0"))
    return (rows.join(common_lines(d, min_docs), "line")
            .groupBy(KEY).agg(F.collect_list("at").alias("drop"), F.count(F.lit(1)).alias("n_lines_removed"),
                              F.sum("n").alias("n_words_removed")))


def _remaining(text: Column, drop: Column) -> Column:
    lines = F.split(text, "\n")
    left = F.array_except(positions(F.size(lines)), drop)
    return F.when(drop.isNull(), text).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))


def quality_rules(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """Counts, base rules, verdict and remaining text of (_doc, text, source) with unique ids.

    Base: at least 50 words, and at most half of them in repeated 3-word windows. A document is depleted if its
    boilerplate lines hold more than half of its words. ``remaining`` is the text without these lines, whatever the
    verdict. Null or empty text: no words, fails the base. Null source: the documents without a source are one host.
    Columns that a caller leaves out cost nothing: texts are moved only for ``remaining``.
    """
    d = text_counts(docs).join(boilerplate_lines(docs, min_docs), KEY, "left")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    removed = F.coalesce("n_words_removed", F.lit(0))
    return d.select(KEY, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (~failed & (2 * removed <= F.col("n_words"))).alias("kept"),
                    removed.alias("n_words_removed"), F.coalesce("n_lines_removed", F.lit(0)).alias("n_lines_removed"),
                    _remaining(F.col("text"), F.col("drop")).alias("remaining"))


def op1_quality_rules(spark, sf_dir):
    """Quality rules over ``documents``, one row per doc_id."""
    d = quality_rules(one_row_per_document(documents(spark, sf_dir), "source")).drop("n_lines_removed", "remaining")
    return d.select(doc_id(), *d.columns[1:])


def op1_remaining_text(spark, sf_dir):
    """What is left of each text of ``documents`` without its boilerplate lines, one row per doc_id."""
    d = quality_rules(one_row_per_document(documents(spark, sf_dir), "source"))
    return d.select(doc_id(), "kept", "n_lines_removed", "n_words_removed",
                    F.length("remaining").cast("long").alias("n_chars"), F.sha2("remaining", 256).alias("text_sha256"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents
), lines AS (
  SELECT doc_id, host, text, line,
         lower(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS k
  FROM (SELECT doc_id, host, text, unnest(ls) AS line FROM d)
), dup AS (
  SELECT doc_id, sum(c - 1) AS n_dup_lines
  FROM (SELECT doc_id, line, count(*) AS c FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL)
  GROUP BY doc_id
), win AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM win) WHERE n >= 2)
  GROUP BY doc_id
), per_line AS (
  SELECT host, k, count(DISTINCT text) AS n FROM lines WHERE k <> '' GROUP BY ALL
), common AS (
  SELECT host, k FROM per_line WHERE n > 10
), gone AS (
  SELECT l.doc_id, sum(len(list_filter(regexp_split_to_array(l.line, '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS n
  FROM lines l JOIN common c ON l.host = c.host AND l.k = c.k GROUP BY l.doc_id
), base AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(text) - length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_words_removed
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone g USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * n_words_removed <= n_words AS kept
FROM base
"""

# The lines that OP1_SQL takes for boilerplate, and its verdict.
OP1_TEXT_SQL = OP1_SQL[:OP1_SQL.rindex("SELECT *,")].rstrip() + r""", marked AS (
  SELECT d.doc_id, p, ls[p] AS line, c.k IS NOT NULL AS gone
  FROM (SELECT doc_id, host, ls, unnest(range(1, len(ls) + 1)) AS p FROM d) d
  LEFT JOIN common c ON d.host = c.host
    AND c.k = lower(trim(ls[p], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))
), left_ AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_lines_removed,
         coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '') AS t
  FROM marked GROUP BY doc_id
)
SELECT doc_id, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * n_words_removed <= n_words AS kept,
       n_lines_removed, n_words_removed, length(t) AS n_chars, sha256(t) AS text_sha256
FROM base JOIN left_ USING (doc_id)
"""
