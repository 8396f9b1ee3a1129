"""Merkle manifest of a data set: leaf coordinates by bitmap ranks, levels by keyed slot arrays.

A group's ids are kept as a compressed bitmap: 64-bit words under (group, id >> 6), built by OR with map-side combining,
words without an id left out. A popcount directory gives each word the ids before it: within blocks of 2^13 words, of
blocks within blocks of 2^15, and so on up to the group. A leaf's place is the directory's entry of its word plus the
bits below its own; the leaves are never sorted. Only rows that share an id are ordered among themselves, by digest.

Levels are then reduced by keys: 512 consecutive places meet in one slot array (group, place >> 9), which is three levels
of eight, in one task. Paths come back the same way: an array gives each of its slots the siblings on the way up, so that
proofs are put together without moving the leaves a second time.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.common import NO_ID, documents, stored
from vitrina.operators.surrogate import dense_index

#: Children of a node, and levels that one slot array reduces.
WIDTH, LEVELS = 8, 3
SLOTS = WIDTH ** LEVELS
_SLOT_BITS = 9
#: Bits of a word's key that each level of the directory takes, from the words up; the group takes what is left.
DIRECTORY = (13, 15, 15)
# Fixed value: the columns of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of a row: of each field `-` if null, else its UTF-8 length, `:` and the value."""
    parts = []
    for value in fields.values():
        s = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def leaves(docs: DataFrame, tampered: Column, changed: dict[str, Column]) -> DataFrame:
    """(group, id, doc_id, leaf, now): ``now`` is the leaf after ``changed`` columns where ``tampered``, else null.

    ``group`` sorts as lang does, null first and bytewise. A null doc_id is an id below all others.
    """
    fields = {c: F.col(c) for c in FIELDS}
    return docs.select(F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("group"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), "doc_id",
                       leaf(fields).alias("leaf"), F.when(tampered, leaf(fields | changed)).alias("now"))


def bitmap(ids: DataFrame) -> DataFrame:
    """(group, word, bits, n, before) of (group, id): ``bits`` of the ids with id >> 6 = word, ``n`` rows, ``before``:
    rows of the group with a smaller word."""
    bit = F.expr("shiftleft(1L, int(id & 63))")
    level = ids.groupBy("group", F.shiftright("id", 6).alias("k0")).agg(F.bit_or(bit).alias("bits"),
                                                                      F.count(F.lit(1)).alias("n"))
    level = stored(level, "words")
    found = level
    for i, width in enumerate((*DIRECTORY, None), 1):
        if width:
            level = level.withColumn(f"k{i}", F.shiftright(f"k{i - 1}", width))
        at = ("group", f"k{i}") if width else ("group",)
        # a block of the directory: at most 2^width rows
        w = Window.partitionBy(*at).orderBy(f"k{i - 1}").rowsBetween(Window.unboundedPreceding, -1)
        own = level.select(*at, f"k{i - 1}", F.coalesce(F.sum("n").over(w), F.lit(0)).alias(f"b{i}"))
        found = found.join(own, ["group", f"k{i - 1}"])
        level = level.groupBy(*at).agg(F.sum("n").alias("n"))
    before = sum((F.col(f"b{i}") for i in range(2, len(DIRECTORY) + 2)), F.col("b1"))
    return found.select("group", F.col("k0").alias("word"), "bits", "n", before.alias("before"))


def placed(rows: DataFrame, words: DataFrame) -> DataFrame:
    """``rows`` (group, id, leaf, ...) with ``pos``, the place of each in its group's order of ids; rows that share an id
    are ordered by their leaf."""
    d = rows.withColumn("word", F.shiftright("id", 6))
    below = F.expr("bits & ~shiftleft(-1L, int(id & 63))")
    more = words.where(F.bit_count("bits") != F.col("n"))  # words with rows that share an id
    if more.limit(1).isEmpty():
        return d.join(words, ["group", "word"]).withColumn("pos", F.col("before") + F.bit_count(below)).select(*rows.columns, "pos")
    d = stored(d, "leaves")
    once = d.join(words.where(F.bit_count("bits") == F.col("n")), ["group", "word"])
    once = once.withColumn("pos", F.col("before") + F.bit_count(below)).select(*rows.columns, "pos")
    # numbered by a range sort: one id may have a third of all rows
    rest = dense_index(d.join(more.select("group", "word"), ["group", "word"], "left_semi"), ["group", "id", "leaf"], "i")
    first = rest.groupBy("group", "word").agg(F.min("i").alias("first"))
    rest = (rest.join(first, ["group", "word"]).join(more, ["group", "word"])
            .withColumn("pos", F.col("before") + F.col("i") - F.col("first")).select(*rows.columns, "pos"))
    return once.unionByName(rest)


def _sha(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels(nodes: list[str], n: int) -> list[list[str]]:
    """The nodes of a slot array and of each level above, at most LEVELS, that a group with ``n`` nodes on this level has."""
    out = [nodes]
    while n > 1 and len(out) <= LEVELS:
        own = out[-1]
        out.append([_sha(own[i:i + WIDTH]) for i in range(0, len(own), WIDTH)])
        n = -(-n // WIDTH)
    return out


def _siblings(levels: list[list[str]], slot: int) -> list[tuple[str, str]]:
    """What stands left and right of a slot in its run, level by level."""
    out = []
    for own in levels[:-1]:
        lo = slot // WIDTH * WIDTH
        out.append(("".join(own[lo:slot]), "".join(own[slot + 1:lo + WIDTH])))
        slot //= WIDTH
    return out


def _reduce(batches):
    for b in batches:
        up = [_levels([x.hex() for x in nodes], n)[-1] for nodes, n in zip(b.column("nodes").to_pylist(), b.column("n").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("group"), b.column("chunk"), pa.array([bytes.fromhex(u[0]) for u in up], pa.binary())],
                                         names=["group", "pos", "leaf"])


def _descend(batches):
    """Of each slot array with its own path: the path of each slot, as left and right siblings a level."""
    for b in batches:
        out = [[], [], [], []]
        for group, chunk, nodes, n, left, right in zip(*(b.column(c).to_pylist() for c in ("group", "chunk", "nodes", "n", "left", "right"))):
            levels = _levels([x.hex() for x in nodes], n)
            for slot in range(len(nodes)):
                own = _siblings(levels, slot)
                for c, v in zip(out, (group, chunk * SLOTS + slot, [x for x, _ in own] + left, [x for _, x in own] + right)):
                    c.append(v)
        kinds = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["group", "pos", "left", "right"])


def slot_arrays(nodes: DataFrame, *carried: str) -> DataFrame:
    """(group, chunk, n, nodes, carried) of (group, pos, leaf, n): 512 consecutive places, in order. ``n``: nodes of the group."""
    rows = F.sort_array(F.collect_list(F.struct("pos", "leaf", *carried)))
    d = nodes.groupBy("group", F.shiftright("pos", _SLOT_BITS).alias("chunk")).agg(F.max("n").alias("n"), rows.alias("r"))
    return d.select("group", "chunk", "n", F.col("r.leaf").alias("nodes"), *[F.col(f"r.{c}").alias(c) for c in carried])


def reduced(chunks: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(group, leaf) of what remains of each group's slot arrays, and the stored slot arrays of the levels above."""
    levels, most = [], chunks.agg(F.max("n")).first()[0] or 0
    while True:
        n = F.ceil(F.col("n") / SLOTS).cast("long").alias("n")
        up = chunks.select("group", "chunk", "nodes", "n").mapInArrow(_reduce, "group string, pos long, leaf binary")
        up = up.join(chunks.groupBy("group").agg(F.max(n).alias("n")), "group")
        if most <= SLOTS:
            return up.select("group", "leaf"), levels
        most = -(-most // SLOTS)
        chunks = stored(slot_arrays(up), "slots")
        levels.append(chunks)


def descended(paths: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(group, pos, left, right): the paths of the places that the lowest slot arrays have, from the groups' own."""
    p = paths.withColumn("pos", F.lit(0).cast("long"))
    for chunks in reversed(levels):
        p = (chunks.join(p.withColumnRenamed("pos", "chunk"), ["group", "chunk"])
             .mapInArrow(_descend, "group string, pos long, left array<string>, right array<string>"))
    return p


def _proofs(batches):
    """Rows of the leaves of a slot array: what they are, the digest of their siblings, and the root that follows from them."""
    for b in batches:
        out = [[] for _ in range(6)]
        for ids, nodes, now, n, left, right, subroot, root in zip(*(b.column(c).to_pylist() for c in (
                "doc_id", "nodes", "now", "n", "left", "right", "subroot", "root"))):
            nodes = [x.hex() for x in nodes]
            levels = _levels(nodes, n)
            above = list(zip(left, right))
            subroot, root = subroot.hex(), root.hex()
            for slot, (i, own, other) in enumerate(zip(ids, nodes, now)):
                path = _siblings(levels, slot) + above
                h = own if other is None else other.hex()
                for before, after in path:
                    h = _sha((before, h, after))
                for c, v in zip(out, (i, own, subroot, root, _sha(x for pair in path for x in pair), h)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), *(pa.array(c, pa.string()) for c in out[1:])],
                                         names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])


def manifest(docs: DataFrame, tampered: Column, changed: dict[str, Column]) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), a row for each row of ``docs``.

    ``folded_root`` is what the siblings make of the leaf that a row has with ``changed`` columns where ``tampered``.
    Null ids come first and, like rows that share an id, are ordered by their digests; null values have their own mark in
    a leaf, null lang is a group. Any number of groups and of rows in one: the order of groups is a range sort of their
    subroots, a task holds slot arrays of 512 places. Columns other than FIELDS don't count. No rows: no rows.
    """
    rows = leaves(docs, tampered, changed)
    words = bitmap(docs.select(F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("group"),
                               F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id")))
    words = stored(words, "directory")
    sizes = words.groupBy("group").agg(F.sum("n").alias("n"))
    rows = placed(rows, words).join(sizes, "group")
    chunks = stored(slot_arrays(rows, "doc_id", "now"), "slots")

    subroots, levels = reduced(chunks)
    subroots = stored(dense_index(subroots, ["group"], "at", start=0), "subroots")
    groups = subroots.select(F.lit("").alias("group"), F.col("at").alias("pos"), "leaf", F.lit(subroots.count()).cast("long").alias("n"))
    top = stored(slot_arrays(groups), "slots")
    root, over = reduced(top)
    the_root = root.first()  # one digest
    none = F.array().cast("array<string>")
    paths = descended(root.select("group", none.alias("left"), none.alias("right")), [top, *over])
    own = paths.select(F.col("pos").alias("at"), "left", "right").join(subroots.select("at", "group"), "at").drop("at")
    p = descended(own, levels)
    if not levels:
        p = p.select("group", "pos", "left", "right")
    ends = subroots.select("group", F.col("leaf").alias("subroot"), F.lit(the_root["leaf"] if the_root else b"").alias("root"))
    d = chunks.join(p.withColumnRenamed("pos", "chunk"), ["group", "chunk"]).join(ends, "group")
    d = d.mapInArrow(_proofs, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return d.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark, sf_dir):
    """The manifest of ``documents``, checked against texts lower-cased where 3 divides the id's crc32."""
    docs = documents(spark, sf_dir)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return manifest(docs, F.coalesce(hit, F.lit(False)), {"text": F.translate("text", upper, upper.lower())})


OP11_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
           || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
           || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
           || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS head,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':'
           || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS low,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
             lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, sha256(head || tail) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(head || low) ELSE sha256(head || tail) END AS now,
         row_number() OVER (PARTITION BY coalesce('=' || lang, '') ORDER BY doc_id NULLS FIRST, sha256(head || tail)) - 1 AS pos,
         count(*) OVER (PARTITION BY coalesce('=' || lang, '')) AS n
  FROM d
), tree AS (
  SELECT 0 AS level, g, pos, leaf AS h, n FROM leaves
  UNION ALL
  SELECT level + 1, g, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 7) // 8
  FROM tree WHERE n > 1 GROUP BY level, g, pos // 8
), subroots AS (
  SELECT g, h, level AS depth, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1
), top AS (
  SELECT 0 AS level, pos, h, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 7) // 8
  FROM top WHERE n > 1 GROUP BY level, pos // 8
), root AS (SELECT h AS root, level AS depth FROM top WHERE n = 1
), path AS (
  SELECT l.g, l.pos AS leaf_pos, 0 AS level, l.pos, l.now AS h, '' AS seen, 0 AS phase, s.depth, s.h AS subroot, s.pos AS lang_pos
  FROM leaves l JOIN subroots s USING (g)
  UNION ALL
  SELECT p.g, p.leaf_pos, CASE WHEN p.level = p.depth THEN 0 ELSE p.level + 1 END,
         CASE WHEN p.level = p.depth THEN p.lang_pos ELSE p.pos // 8 END,
         CASE WHEN p.level = p.depth THEN p.h ELSE sha256(coalesce(s.l, '') || p.h || coalesce(s.r, '')) END,
         CASE WHEN p.level = p.depth THEN p.seen ELSE p.seen || coalesce(s.l, '') || coalesce(s.r, '') END,
         CASE WHEN p.level = p.depth THEN p.phase + 1 ELSE p.phase END,
         CASE WHEN p.level = p.depth THEN (SELECT depth FROM root) ELSE p.depth END, p.subroot, p.lang_pos
  FROM path p LEFT JOIN (
    SELECT a.phase, a.g, a.level, a.pos, string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos) AS l,
           string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos) AS r
    FROM (SELECT 0 AS phase, g, level, pos, h FROM tree UNION ALL SELECT 1, '', level, pos, h FROM top) a
    JOIN (SELECT 0 AS phase, g, level, pos, h FROM tree UNION ALL SELECT 1, '', level, pos, h FROM top) b
      ON a.phase = b.phase AND a.g = b.g AND a.level = b.level AND a.pos // 8 = b.pos // 8
    GROUP BY a.phase, a.g, a.level, a.pos
  ) s ON s.phase = p.phase AND s.level = p.level AND s.pos = p.pos AND s.g = CASE WHEN p.phase = 0 THEN p.g ELSE '' END
  WHERE p.phase < 2
)
SELECT l.doc_id, l.leaf, p.subroot, (SELECT root FROM root) AS root, sha256(p.seen) AS proof_sha256, p.h AS folded_root,
       p.h = (SELECT root FROM root) AS verified
FROM path p JOIN leaves l ON p.g = l.g AND p.leaf_pos = l.pos WHERE p.phase = 2
"""
