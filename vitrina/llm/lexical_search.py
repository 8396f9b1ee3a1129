"""Ranked lexical search by pipelined term partitioning.

Documents are indexed in blocks of at most BLOCK rows; a block's postings are split by the term owner, one row an owner.
Owners are classes of document frequency, rare terms first. Items travel in bundles, one a block, that carry a sparse
accumulator over the block's documents through the owners in turn: a cogroup of bundles and postings by block adds what
each owner's terms contribute, in 64-bit integers, so the order of owners can't change a score.

After an owner the least that an item's 50th document has is known over all blocks. A document whose sum, with the most
that the terms still to come could add, stays below it can't be among the 50 and leaves the accumulator. That bound is
exact; common terms are then only added up for documents that may still rank. A last selection merges each block's best.

Terms are known by a 64-bit hash. Which terms items ask for reaches the indexing tasks as a Bloom filter of fixed size;
what it lets through in error no item asks for later.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.common import NO_ID, documents, stored
from vitrina.llm.textbytes import SliceHash, chunks, encoded
from vitrina.sources.tables import read_table

#: Documents of a block, and items of a bundle: a dense accumulator has at most this many places.
BLOCK, BUNDLE = 2048, 256
#: Blocks that one copy of a bundle's items meets.
SPREAD = 8
#: Owners: terms in at most this share of the documents, in turn; the last owner has the rest.
OWNERS = (0.01, 0.1)
#: Bits of the filter of terms asked for.
FILTER = 1 << 23
# Fixed values of the score.
SLOPE, K1, SCALE = 50, 20, 1_000_000_000
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every term of the texts, in order. A term is a run of ASCII letters and digits and of characters
    beyond ASCII; A-Z are lower-cased."""
    at, out = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for lo, hi in chunks(texts):
        b = np.frombuffer(b"\n".join(texts[lo:hi]).lower() + b"\n", np.uint8)
        edge = np.diff(_TERM[b].astype(np.int8), prepend=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        first = np.cumsum([0] + [len(t) + 1 for t in texts[lo:hi]])
        out.append(SliceHash(b)(start, end))
        at.append(np.searchsorted(first, start, "right") - 1 + lo)
    return np.concatenate(at), np.concatenate(out)


def _probes(h: np.ndarray) -> np.ndarray:
    return np.stack([h % np.uint64(FILTER), (h >> np.uint64(32)) % np.uint64(FILTER)])


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term) of (item, text): the distinct terms of each item."""
    def rows(batches):
        for b in batches:
            at, h = term_hashes(encoded(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(h.view(np.int64))], names=["item", "term"])
    return items.select("item", "text").mapInArrow(rows, "item long, term long").distinct()


def term_filter(terms: DataFrame) -> np.ndarray:
    """The filter of (term), as FILTER booleans: put together by the executors, at most FILTER / 64 words come here."""
    def rows(batches):
        for b in batches:
            p = _probes(b.column(0).to_numpy().view(np.uint64)).ravel().astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(p >> 6), pa.array(np.int64(1) << (p & 63))], names=["word", "bit"])
    words = terms.select("term").mapInArrow(rows, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(FILTER // 64, np.int64)
    for r in words.collect():
        out[r["word"]] = r["bits"]
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def index(docs: DataFrame, asked: np.ndarray) -> DataFrame:
    """(block, term, ids, doc, tf) of (id, text): for each block a row without term, with its documents' ids and, in tf,
    numbers of terms; and a row for each term that may be asked for, with the documents (places in ids) that hold it and
    how often. Blocks are numbered by task, so the index is to be stored."""
    def rows(batches):
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                at, h = term_hashes(encoded(part.column(1)))
                n = np.bincount(at, minlength=part.num_rows)
                p = _probes(h)
                hit = asked[p[0]] & asked[p[1]]
                terms, own = np.unique(h[hit], return_inverse=True)
                key, tf = np.unique(own.astype(np.int64) * BLOCK + at[hit], return_counts=True)
                ends = np.searchsorted(key, np.arange(1, len(terms) + 1) * BLOCK)
                none = np.zeros(len(terms), np.int64)
                lists = lambda first, values: pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0, len(first)], len(first) + ends]), pa.int32()),
                    pa.array(np.concatenate([first, values]), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(terms) + 1, block)), pa.array([None, *terms.view(np.int64).tolist()], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, len(n), *(none + len(n))], pa.int32()), pa.array(part.column(0), pa.int64())),
                     lists(n[:0], key % BLOCK), lists(n, tf)], names=["block", "term", "ids", "doc", "tf"])
                block += 1
    return docs.select("id", "text").mapInArrow(rows, "block long, term long, ids array<long>, doc array<int>, tf array<int>")


def weights(postings: DataFrame, n_docs: int) -> DataFrame:
    """(term, w, owner) of the terms in the index."""
    df = postings.groupBy("term").agg(F.sum(F.size("doc")).alias("df"))
    w = F.floor(1000 * F.log((2 * F.lit(float(n_docs)) + 2) / (2 * F.col("df").cast("double") + 1))).cast("long")
    owner = sum(((F.col("df") > F.lit(share * n_docs)).cast("int") for share in OWNERS), F.lit(0))
    return df.select("term", w.alias("w"), owner.alias("owner"))


def bundles(asked: DataFrame) -> DataFrame:
    """(bundle, items, rest) of (bundle, item, term, w, owner): ``rest`` has, for each owner, the most that the owners
    after it can add to each of ``items``. A term adds less than w * SCALE / 1000."""
    after = [F.coalesce(F.sum(F.when(F.col("owner") > o, F.col("w"))), F.lit(0)).alias(f"r{o}") for o in range(len(OWNERS) + 1)]
    x = F.sort_array(F.collect_list(F.struct("item", *[f"r{o}" for o in range(len(OWNERS) + 1)]))).alias("x")
    rest = F.array(*[F.transform(F.col(f"x.r{o}"), lambda v: v * (SCALE // 1000)) for o in range(len(OWNERS) + 1)])
    return (asked.groupBy("bundle", "item").agg(*after).groupBy("bundle").agg(x)
            .select("bundle", F.col("x.item").alias("items"), rest.alias("rest")))


_LISTS = ("ids", "n", "items", "at", "score", "top_item", "top_id", "top_score")
_TRAVEL = f"block long, bundle long, rest array<array<long>>, {', '.join(f'{c} array<long>' for c in _LISTS)}"


def _add(owner: int, n_docs: int, n_terms: int, top: int):
    """The owner's stage of one bundle and block. Left: the bundle, with the least score that each of its items asks for;
    right: a row for each item and term of the owner that the block has."""
    last = owner == len(OWNERS)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        values = lambda c: left.column(c).combine_chunks().flatten().to_numpy()
        items, ids, n = values("items"), values("ids"), values("n")
        rest, least = np.array(left.column("rest")[0].as_py()[owner]), values("least")
        acc = np.zeros((len(items), len(ids)), np.int64)
        acc.ravel()[values("at")] = values("score")
        m = 100 - SLOPE + (SLOPE * n * n_docs) // n_terms
        for batch in right.to_batches():
            doc, tf = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("doc", "tf"))
            ends = np.cumsum(pa.compute.list_value_length(batch.column("doc")).to_numpy())
            part = (SCALE * tf) // (1000 * tf + K1 * m[doc])
            start = 0
            for end, w, asking in zip(ends.tolist(), batch.column("w").to_pylist(), batch.column("items").to_pylist()):
                for k in np.searchsorted(items, asking):
                    acc[k, doc[start:end]] += w * part[start:end]
                start = end
        acc[acc + rest[:, None] < least[:, None]] = 0  # can't be among the best any more
        found = [np.zeros(0, np.int64)]
        for k in range(len(items)):
            have = np.flatnonzero(acc[k])
            found.append(have[np.lexsort((ids[have], -acc[k, have]))[:top]] + k * len(ids))
        best = np.concatenate(found)
        flat = np.flatnonzero(acc) if not last else best[:0]
        lists = dict(zip(_LISTS, (ids, n, items, flat, acc.ravel()[flat], items[best // len(ids)], ids[best % len(ids)], acc.ravel()[best])))
        return pa.table([left.column("block"), left.column("bundle"), left.column("rest"),
                         *[pa.array([lists[c]], pa.list_(pa.int64())) for c in _LISTS]], names=["block", "bundle", "rest", *_LISTS])
    return run


def _least(best: DataFrame, of: DataFrame, top: int) -> DataFrame:
    """(bundle, least): the score that the items of a bundle have at least at their ``top``th document, 1 without."""
    w = Window.partitionBy("item").orderBy(F.desc("score"))
    kth = best.withColumn("k", F.row_number().over(w)).where(F.col("k") <= top).groupBy("item").agg(
        F.when(F.count(F.lit(1)) == top, F.min("score")).alias("kth"))
    each = of.select("bundle", F.explode("items").alias("item")).join(kth, "item", "left")
    return (each.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("item", F.coalesce("kth", F.lit(1)).alias("kth")))).alias("x"))
            .select("bundle", F.col("x.kth").alias("least")))


def ranked(docs: DataFrame, items: DataFrame, top: int = 50) -> DataFrame:
    """(item, rank, id, score): the ``top`` documents with the highest scores above 0 of each item, ties by ascending id.

    ``docs``: (id, text), ``items``: (item, text). Every row of ``docs`` is a document, also if ids repeat (then several
    can rank, with the same id); rows that share an item are one item. Null or empty text has no terms. A task holds a
    block's postings and an accumulator of BUNDLE * BLOCK numbers.
    """
    asked = stored(item_terms(items), "terms")
    found = stored(index(docs, term_filter(asked)), "index")
    postings, heads = found.where("term is not null").drop("ids"), found.where("term is null")
    stats = heads.select(F.explode("tf").alias("n")).agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_docs, n_terms = stats[0], max(stats[1], 1)
    groups = max(1, -(-asked.select("item").distinct().count() // BUNDLE))
    asked = (asked.join(weights(postings, n_docs), "term")
             .withColumn("bundle", F.pmod(F.xxhash64(F.lit("bundle"), "item"), F.lit(groups).cast("long"))))
    asked = stored(asked, "asked")
    owned = asked.groupBy("bundle", "term").agg(F.min("w").alias("w"), F.min("owner").alias("owner"),
                                                F.collect_list("item").alias("items"))
    posted = stored(postings.join(owned, "term").select("block", "bundle", "owner", "w", "items", "doc", "tf"), "posted")
    of = stored(bundles(asked), "bundles")

    salts = -(-max(1, heads.count()) // SPREAD)  # one bundle may be all there are

    def with_bundle(rows: DataFrame, own: DataFrame) -> DataFrame:
        own = own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return rows.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int")).join(own, ["bundle", "salt"]).drop("salt")

    empty = F.array().cast("array<long>")
    travel = heads.select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("bundle"), "ids",
                          F.col("tf").cast("array<long>").alias("n"), empty.alias("at"), empty.alias("score"))
    travel = with_bundle(travel, of)
    least = of.select("bundle", F.transform("items", lambda x: F.lit(1).cast("long")).alias("least"))
    for owner in range(len(OWNERS) + 1):
        left = with_bundle(travel.select("block", "bundle", "rest", *_LISTS[:5]), least)
        right = posted.where(F.col("owner") == owner).select("block", "bundle", "w", "items", "doc", "tf")
        travel = (left.groupBy("block", "bundle").cogroup(right.groupBy("block", "bundle"))
                  .applyInArrow(_add(owner, n_docs, n_terms, top), _TRAVEL))
        travel = stored(travel, "travel")
        best = travel.select(F.explode(F.arrays_zip("top_item", "top_id", "top_score")).alias("b")).select(
            F.col("b.top_item").alias("item"), F.col("b.top_id").alias("id"), F.col("b.top_score").alias("score"))
        least = _least(best, of, top)
    w = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select("item", "rank", "id", "score")


def op13_lexical_search(spark, sf_dir):
    """The 50 best ``documents`` for each ``benchmark`` item."""
    docs = documents(spark, sf_dir).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text")
    items = read_table(spark, sf_dir, "benchmark").select(F.coalesce("item_id", F.lit(NO_ID)).alias("item"), "text")
    back = lambda c, name: F.nullif(F.col(c), F.lit(NO_ID)).alias(name)
    return ranked(docs, items).select(back("item", "item_id"), "rank", back("id", "doc_id"), "score")


OP13_SQL = r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM documents
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark
), len_ AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id
), total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM len_
), tf AS (SELECT doc_id, t, count(*) AS tf FROM terms WHERE t IN (SELECT t FROM asked) GROUP BY doc_id, t
), w AS (
  SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY t, n_docs
), part AS (
  SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))) AS s
  FROM tf JOIN len_ USING (doc_id) JOIN w USING (t), total
), scored AS (
  SELECT item_id, doc_id, sum(s)::BIGINT AS score FROM asked JOIN part USING (t) GROUP BY item_id, doc_id
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
WHERE rank <= 50
"""
