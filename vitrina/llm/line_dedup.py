"""Line dedup: lines that many documents share stay in one document only.

Normalised lines of all documents are exploded to (128-bit hash, document, positions), documents are counted per
hash with map-side combining, and lines over the threshold are dropped everywhere but in the document with the largest
id. Positions to drop go back to their document, which is put together again from the other positions. A line that a
third of all documents hold is one row per map task in the count; in the join that finds its occurrences its partition
is split by adaptive execution, because the other side has a single row for it.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import KEY, doc_id, documents, map_batches, one_row_per_document

# Fixed value: what is stripped from both ends of a line.
STRIP = b" \t\n\x0b\x0c\r"


def _line_rows(min_chars: int):
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        docs, high, low, at = [], [], [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found: dict[bytes, list[int]] = {}
            # bytes.lower() changes A-Z only
            for pos, line in enumerate((text or "").encode().lower().split(b"\n")):
                key = line.strip(STRIP)
                if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
                    found.setdefault(xxhash.xxh3_128_digest(key), []).append(pos)
            for h, pos in found.items():
                docs.append(doc)
                high.append(int.from_bytes(h[:8], "big", signed=True))
                low.append(int.from_bytes(h[8:], "big", signed=True))
                at.append(pos)
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(high, pa.int64()),
                                           pa.array(low, pa.int64()), pa.array(at, pa.list_(pa.int32()))],
                                          names=[KEY, "h1", "h2", "at"])
    return rows


def shared_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(_doc, drop): positions of the lines to drop, for the documents that lose any. ``docs``: (_doc, text), unique
    ids."""
    lines = map_batches(docs, _line_rows(min_chars), f"{KEY} long, h1 long, h2 long, at array<int>")
    over = (lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max(KEY).alias("keeper"))
            .where(F.col("n") >= min_docs).drop("n"))
    return (lines.join(over, ["h1", "h2"]).where(F.col(KEY) != F.col("keeper"))
            .groupBy(KEY).agg(F.flatten(F.collect_list("at")).alias("drop")))


def drop_shared_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(_doc, n_lines, n_dropped, kept): ``kept`` is the text without the dropped lines.

    ``docs``: (_doc, text) with unique ids. A null or empty text is one empty line, which is never dropped (it is
    shorter than ``min_chars``). Lines are split at \\n only; a line repeated in one document counts that document
    once, and all its occurrences stay or go together. Memory: one document, and the positions to drop in it.
    """
    d = docs.join(shared_lines(docs, min_chars, min_docs), KEY, "left")
    d = d.select(KEY, F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"),
                 F.coalesce("drop", F.array().cast("array<int>")).alias("drop"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    kept = F.when(F.size("drop") == 0, F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"))
    return d.select(KEY, F.size("lines").cast("long").alias("n_lines"), F.size("drop").cast("long").alias("n_dropped"),
                    kept.alias("kept"))


def op7_line_dedup(spark, sf_dir):
    """Line dedup of ``documents``. One row per doc_id (repeated ids: see one_row_per_document)."""
    d = drop_shared_lines(one_row_per_document(documents(spark, sf_dir)))
    return d.select(doc_id(), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), over AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT a.doc_id, a.pos, a.line, o.k IS NOT NULL AND a.doc_id <> o.keeper AS gone
  FROM keyed a LEFT JOIN over o ON a.k = o.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
