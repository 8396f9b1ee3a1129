"""Suffix-array dedup by prefix-free parsing: every byte in a repeat of WIDTH bytes goes, but in the first occurrence.

Parse. A rolling hash of GRAM bytes triggers where it is the least among REACH neighbouring starts; every WIDTH-byte
string holds a trigger, and equal strings hold it at the same place. The text between and around triggers is the
phrase of a trigger: all bytes that a WIDTH-byte string through it can reach.

Dictionary. Triggers whose gram occurs once in the corpus have no part in a repeat and leave. Equal phrases become one
dictionary entry with its first place in the corpus; at every other place the whole phrase is a repeat. So copies, a
template or a passage that a third of all documents hold cost one entry, however often they occur.

Corpus order. What is left are entries that share a gram but differ somewhere. For each of the REACH offsets the
entries of one gram are sorted by their WIDTH-byte strings at that offset, ties by place: all but the first of equal
neighbours are repeats. Entries of a gram with up to GROUP entries are sorted together in one task's arrays (many grams
at a time); the strings of grams with more are spread by their hash and reduced with map-side combining instead.

Repeated starts go back to their documents, where they are joined to spans. Byte strings are compared by hash: phrases by
64 bits of the gram and 64 of the phrase, strings of spread grams by 128 bits, strings of one gram and offset by 64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import KEY, doc_id, documents, map_batches, one_row_per_document, stored
from vitrina.llm.textbytes import SliceHash, chunks, encoded, mix, packed, second_hash, unpacked

WIDTH = 100
#: Bytes of the rolling hash (a power of two), and the starts among which it triggers.
GRAM = 32
#: Entries of one gram that are sorted in one task: some 4 MB of phrases and 15 MB of keys, a fourteenth of what their
#: strings would be in a shuffle.
GROUP = 20_000
#: Entries that are sorted at a time, and phrases that are hashed at a time.
BATCH, HASHED = 8192, 4096
_TABLE = np.random.default_rng(11).integers(0, 2 ** 64, 256, dtype=np.uint64)


def rolling(b: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each start."""
    h, width, factor = _TABLE[b], 1, 0x9E3779B97F4A7C15
    while width < GRAM:
        h = h[:-width] * np.uint64(factor) + h[width:]
        width, factor = 2 * width, factor * factor % 2 ** 64
    return mix(h)


def _slide(best, a: np.ndarray, width: int) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` neighbours, by doubling."""
    done = 1
    while 2 * done <= width:
        a, done = best(a[:-done], a[done:]), 2 * done
    return best(a[:len(a) - (width - done)], a[width - done:]) if done < width else a


def triggers(h: np.ndarray, reach: int) -> np.ndarray:
    """Starts whose hash is the least of some ``reach`` neighbouring starts (all of them where several are equal)."""
    order = (h >> np.uint64(32)).astype(np.uint32)
    if len(order) < reach:
        return np.zeros(0, np.int64)
    edge = np.zeros(reach - 1, np.uint32)
    least = np.concatenate([edge, _slide(np.minimum, order, reach), edge])
    return np.flatnonzero(_slide(np.maximum, least, reach) == order)


def _parsed(texts: list[bytes], width: int):
    """(first text, bytes, start of each text, text of each trigger, trigger, hash) of chunks of texts."""
    for lo, hi in chunks(texts):
        part = texts[lo:hi]
        b = np.frombuffer(b"".join(part), np.uint8)
        if len(b) < width:
            continue
        first = np.cumsum([0] + [len(t) for t in part])
        h = rolling(b)
        at = triggers(h, width - GRAM + 1)
        doc = np.searchsorted(first, at, side="right") - 1
        # triggers of grams across two documents, and of documents too short for a repeat, are none
        ok = (at + GRAM <= first[doc + 1]) & (first[doc + 1] - first[doc] >= width)
        yield lo, b, first, doc[ok], at[ok], h[at[ok]]


def _bounds(at: np.ndarray, begin, end, width: int):
    """Start and end of the phrases of triggers in texts from ``begin`` to ``end``."""
    return np.maximum(at - (width - GRAM), begin), np.minimum(at + width, end)


def _triggers_of(width: int, phrases: bool):
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = np.array(batch.column(0).to_pylist(), np.int64)
        cols = [[], [], [], []]
        for chunk, b, first, doc, at, h in _parsed(encoded(batch.column(1)), width):
            cols[2].append(h.view(np.int64))
            if phrases:
                lo, hi = _bounds(at, first[doc], first[doc + 1], width)
                # where the trigger stands in its phrase belongs to the phrase
                place = mix((at - lo).astype(np.uint64) + np.uint64(1))
                cols[0].append(ids[chunk + doc])
                cols[1].append((at - first[doc]).astype(np.int32))
                cols[3].append((SliceHash(b)(lo, hi) ^ place).view(np.int64))
        kinds = ((0, KEY, np.int64), (1, "at", np.int32), (2, "gram", np.int64), (3, "phrase", np.int64))
        kinds = [k for k in kinds if phrases or k[0] == 2]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, t), *cols[i]])) for i, _, t in kinds],
                                          names=[n for _, n, _ in kinds])
    return rows


def _strings(b: np.ndarray, at: np.ndarray, width: int):
    """(trigger index, offset back from the trigger, start, end) of all strings through triggers of one text."""
    back = np.arange(width - GRAM + 1)
    start = at[:, None] - back[None, :]
    ok = (start >= 0) & (start + width <= len(b))
    i, d = np.nonzero(ok)
    return i, d, start[i, d]


def _entries(width: int):
    """Batches of (_doc, packed, ats): the bytes of the phrase of each trigger, for sorting in groups."""
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, where, grams, front, phrases = [], [], [], [], []
        for doc, text, ats in zip(batch.column(0).to_pylist(), unpacked(batch.column(1)), batch.column(2)):
            b = np.frombuffer(text, np.uint8)
            at = np.sort(ats.values.to_numpy()).astype(np.int64)
            lo, hi = _bounds(at, 0, len(b), width)
            ids += [doc] * len(at)
            where += at.tolist()
            grams.append(SliceHash(b)(at, at + GRAM).view(np.int64))
            front += (at - lo).tolist()
            phrases += [text[s:e] for s, e in zip(lo.tolist(), hi.tolist())]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(where, pa.int32()),
                                           pa.array(np.concatenate(grams)), pa.array(front, pa.int16()),
                                           pa.array(phrases, pa.binary())], names=[KEY, "at", "gram", "front", "phrase"])
    return rows


def _sorted_groups(width: int):
    """Over rows sorted by gram: for each entry the offsets at which its string is not the first of its kind."""
    def repeats(cols) -> pa.RecordBatch:
        doc, at, gram, front, phrase = cols
        order = np.lexsort((at, doc))  # corpus order of the places
        doc, at, gram, front = (x[order] for x in (doc, at, gram, front))
        backs = np.arange(width - GRAM + 1)
        keys = np.zeros((len(doc), len(backs)), np.uint64)
        whole = np.zeros(keys.shape, bool)
        for lo in range(0, len(doc), HASHED):
            part = [phrase[i] for i in order[lo:lo + HASHED].tolist()]
            first = np.cumsum([0] + [len(p) for p in part])
            start = (first[:-1] + front[lo:lo + HASHED])[:, None] - backs
            i, j = np.nonzero((start >= first[:-1, None]) & (start + width <= first[1:, None]))
            s = start[i, j]
            keys[lo + i, j] = mix(SliceHash(np.frombuffer(b"".join(part), np.uint8))(s, s + width) ^ gram[lo + i].view(np.uint64))
            whole[lo + i, j] = True
        gone = [[] for _ in range(len(doc))]
        for back in backs.tolist():
            own = np.flatnonzero(whole[:, back])
            key = keys[own, back]
            by = np.argsort(key, kind="stable")  # equal strings in corpus order
            same = np.flatnonzero(key[by][1:] == key[by][:-1]) + 1
            for i in own[by[same]].tolist():
                gone[i].append(int(at[i]) - back)
        some = [i for i, g in enumerate(gone) if g]
        return pa.RecordBatch.from_arrays([pa.array(doc[some], pa.int64()),
                                           pa.array([gone[i] for i in some], pa.list_(pa.int32()))], names=[KEY, "starts"])

    def run(batches):
        left = None  # rows of a gram that may go on in the next batch
        for batch in batches:
            t = pa.Table.from_batches([batch])
            left = t if left is None else pa.concat_tables([left, t])
            if left.num_rows < BATCH:
                continue
            gram = left.column("gram").to_numpy()
            cut = int(np.searchsorted(gram, gram[-1]))
            if cut:
                yield repeats(_columns(left.slice(0, cut)))
                left = left.slice(cut)
        if left is not None and left.num_rows:
            yield repeats(_columns(left))
    return run


def _columns(t: pa.Table):
    return (*(t.column(c).to_numpy() for c in (KEY, "at", "gram")), t.column("front").to_numpy().astype(np.int64),
            t.column("phrase").to_pylist())


def _spread_strings(width: int):
    """Batches of (_doc, packed, ats): the hashed strings through each trigger."""
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols = [[], [], [], []]
        for doc, text, ats in zip(batch.column(0).to_pylist(), unpacked(batch.column(1)), batch.column(2)):
            b = np.frombuffer(text, np.uint8)
            at = np.sort(ats.values.to_numpy()).astype(np.int64)
            _, _, start = _strings(b, at, width)
            start = np.unique(start)
            for c, v in zip(cols, (np.full(len(start), doc, np.int64), start.astype(np.int32),
                                   SliceHash(b)(start, start + width).view(np.int64),
                                   second_hash(b)(start, start + width).view(np.int64))):
                c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names=[KEY, "start", "s1", "s2"])
    return rows


def _cut(width: int):
    """Batches of (_doc, packed, ats, firsts, starts): what is left of each text."""
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[], [], [], [], []]
        for doc, text, ats, firsts, starts in zip(batch.column(0).to_pylist(), unpacked(batch.column(1)),
                                                  *[batch.column(i) for i in (2, 3, 4)]):
            n = len(text)
            edge = np.zeros(n + 1, np.int64)
            if ats.is_valid:
                rest = np.setdiff1d(ats.values.to_numpy(), firsts.values.to_numpy() if firsts.is_valid else [])
                lo, hi = _bounds(rest.astype(np.int64), 0, n, width)
                lo, hi = lo[hi - lo >= width], hi[hi - lo >= width]
                if starts.is_valid:
                    s = starts.values.to_numpy().astype(np.int64)
                    lo, hi = np.concatenate([lo, s]), np.concatenate([hi, s + width])
                np.add.at(edge, lo, 1)
                np.add.at(edge, hi, -1)
            gone = np.cumsum(edge[:-1]) > 0
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if gone.any() else text
            spans = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0) == 1) if n else gone
            for c, v in zip(out, (doc, n, n - len(kept), len(spans), kept)):
                c.append(v)
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in out[:4]], pa.array(out[4], pa.binary())],
                                          names=[KEY, "n_bytes", "n_removed", "n_spans", "kept"])
    return rows


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(_doc, n_bytes, n_removed, n_spans, kept): ``kept`` is the bytes that are left of each text.

    ``docs``: (_doc, text) with unique ids; null as empty. Earlier means a smaller id, or an earlier start in the same
    document; strings never cross documents, may overlap, and are judged on the input. A cut may fall inside a
    character, so ``kept`` is binary. Memory of a task: about one megabyte of text (or one longer document) and its
    hashes, or GROUP + BATCH dictionary entries.
    """
    docs = docs.select(KEY, "text")
    grams = map_batches(docs, _triggers_of(width, phrases=False), "gram long")
    shared = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    found = map_batches(docs, _triggers_of(width, phrases=True), f"{KEY} long, at int, gram long, phrase long")
    hits = stored(found.join(shared, "gram"), "triggers")
    text = packed(docs)

    # dictionary: each distinct phrase and its first place
    entries = (hits.groupBy("gram", "phrase").agg(F.min(F.struct(KEY, "at")).alias("first"))
               .select("gram", F.col(f"first.{KEY}").alias(KEY), F.col("first.at").alias("at")))
    entries = stored(entries, "dictionary")
    sizes = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("size"))
    lists = stored(entries.join(sizes, "gram").groupBy(KEY).agg(
        F.collect_list("at").alias("firsts"),
        F.collect_list(F.when(F.col("size").between(2, GROUP), F.col("at"))).alias("grouped"),
        F.collect_list(F.when(F.col("size") > GROUP, F.col("at"))).alias("spread")), "entries")

    again = text.join(lists.drop("firsts"), KEY)
    grouped = map_batches(again.where(F.size("grouped") > 0).select(KEY, "packed", "grouped"), _entries(width),
                          f"{KEY} long, at int, gram long, front short, phrase binary")
    grouped = grouped.repartition("gram").sortWithinPartitions("gram").mapInArrow(
        _sorted_groups(width), f"{KEY} long, starts array<int>")
    strings = map_batches(again.where(F.size("spread") > 0).select(KEY, "packed", "spread"), _spread_strings(width),
                          f"{KEY} long, start int, s1 long, s2 long")
    first = strings.groupBy("s1", "s2").agg(F.min(F.struct(KEY, "start")).alias("first"), F.count(F.lit(1)).alias("n"))
    spread = (strings.join(first.where("n > 1"), ["s1", "s2"]).where(F.struct(KEY, "start") != F.col("first"))
              .groupBy(KEY).agg(F.collect_list("start").alias("starts")))
    starts = grouped.unionByName(spread).groupBy(KEY).agg(F.flatten(F.collect_list("starts")).alias("starts"))

    hits = hits.groupBy(KEY).agg(F.collect_list("at").alias("ats"))
    every = text.join(hits, KEY, "left").join(lists.select(KEY, "firsts"), KEY, "left").join(starts, KEY, "left")
    return map_batches(every.select(KEY, "packed", "ats", "firsts", "starts"), _cut(width),
                       f"{KEY} long, n_bytes long, n_removed long, n_spans long, kept binary")


def op9_suffix_dedup(spark, sf_dir):
    """Repeats of 100 bytes removed from ``documents``; one row per doc_id."""
    d = remove_repeats(one_row_per_document(documents(spark, sf_dir)))
    return d.select(doc_id(), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (
  SELECT doc_id, i, b[i:i + 99] AS s FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 98)) AS i FROM d)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM w) WHERE n > 1
), span AS (
  SELECT doc_id, min(i) AS a, max(i) + 99 AS z FROM (
    SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM (
      SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS fresh FROM again))
  GROUP BY doc_id, g
), gap AS (  -- what is left before each span, and behind the last
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS f, a - 1 AS t FROM span
  UNION ALL SELECT d.doc_id, coalesce(max(z), 0) + 1, max(octet_length(b)) FROM d LEFT JOIN span USING (doc_id) GROUP BY d.doc_id
), rest AS (
  SELECT doc_id, string_agg(CASE WHEN f <= t THEN hex(b[f:t]) ELSE '' END, '' ORDER BY f, t) AS h
  FROM gap JOIN d USING (doc_id) GROUP BY doc_id
), gone AS (SELECT doc_id, sum(z - a + 1) AS n, count(*) AS k FROM span GROUP BY doc_id)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(k, 0) AS BIGINT) AS n_spans,
       sha256(unhex(h)) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) JOIN rest USING (doc_id)
"""
