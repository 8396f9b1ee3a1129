"""Near-dedup: b-bit MinHash signatures joined under a Hamming threshold with a multi-index.

A signature has SYMBOLS minima of b = 16 bits. It is split into CHUNKS chunks; by pigeonhole two signatures that differ
in at most T symbols differ in at most T // CHUNKS = 1 symbol of some chunk, so the chunk with each one of its symbols
left out in turn (the allowed error, enumerated) makes keys of which such a pair shares at least one. With 28 symbols
in 7 chunks of 4 every pair within T = 13 symbols meets; at a likeness of 0.85 the distance is binomial(28, 0.15), so a
pair lies beyond T with probability 1.2e-5, and less for likelier pairs. Candidates are confirmed on full sets.

Texts with the same shingle set are one class and enter as one member. The members of a key are not paired with one
another. Each is compared, on full sets, with one hub of the key. Where a key's members then are in several components,
its centre, the member that differs least from the hub, is the hub of a second round; that also tells which shingles of
each member the centre lacks. If there are still several components, two members x, y that are alike enough to be linked either share
one of the first shingles that the hub lacks (of the prefix that any partner must touch, in one order for both), or
both hold enough of the hub. Each member also has two bitmaps, of the hub's shingles that it misses and of its own that the
hub lacks: a bit that one of two members has and the other has not is a shingle that they do not share. Only pairs, across
components, that can still be alike enough are compared: no link is missed, and members that differ from the centre each
in their own way meet nobody. A passage or template that very many texts share is the centre's and makes no pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import KEY, doc_id, documents, map_batches, one_row_per_document, stored
from vitrina.llm.graph import components
from vitrina.llm.textbytes import encoded, packed, shingle_sets, unpacked

CHUNKS, PER_CHUNK, ERRORS = 7, 4, 1
SYMBOLS = CHUNKS * PER_CHUNK
#: Largest signature distance for which a shared key is guaranteed.
T = CHUNKS * (ERRORS + 1) - 1
#: Members compared with one copy of their hub in one task.
SPREAD = 512
#: Longs of a bitmap of what a member misses of its hub, and of one of what the hub lacks of it.
LONGS = 4
_rng = np.random.default_rng(7)
_XOR = _rng.integers(0, 2 ** 64, SYMBOLS, dtype=np.uint64)
_TIMES = _rng.integers(0, 2 ** 64, SYMBOLS, dtype=np.uint64) | np.uint64(1)


def signatures(docs: DataFrame) -> DataFrame:
    """(_doc, n, c1, c2, sig): size and 128-bit digest of the shingle set, signature of two bytes a symbol."""
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = list(shingle_sets(encoded(batch.column(1))))
        size = np.array([len(s) for s in sets])
        sig = np.zeros((len(sets), SYMBOLS), ">u2")
        if some := np.flatnonzero(size).tolist():
            step = 256  # documents hashed together
            for lo in range(0, len(some), step):
                own = some[lo:lo + step]
                u = np.concatenate([sets[i] for i in own])
                at = np.cumsum([0] + [len(sets[i]) for i in own[:-1]])
                for k in range(SYMBOLS):
                    v = ((u ^ _XOR[k]) * _TIMES[k]) >> np.uint64(32)
                    sig[own, k] = np.minimum.reduceat(v, at) & np.uint64(0xFFFF)
        digest = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        c = np.frombuffer(b"".join(digest), ">i8").astype(np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(c[:, 0]), pa.array(c[:, 1]),
             pa.array([r.tobytes() for r in sig], pa.binary())], names=[KEY, "n", "c1", "c2", "sig"])
    return map_batches(docs.select(KEY, "text"), rows, f"{KEY} long, n long, c1 long, c2 long, sig binary")


def _symbol(sig: str, k: int) -> Column:
    return F.substring(F.col(sig), 2 * k + 1, 2)


def keys(sig: str = "sig") -> Column:
    """The keys of a signature: each chunk without each of its symbols."""
    out = []
    for c in range(CHUNKS):
        for left_out in range(PER_CHUNK):
            rest = [_symbol(sig, c * PER_CHUNK + j) for j in range(PER_CHUNK) if j != left_out]
            out.append(F.xxhash64(F.lit(c * PER_CHUNK + left_out), *rest))
    return F.array(*out)


def distance(a: str, b: str) -> Column:
    """Symbols in which two signatures differ."""
    return sum(((_symbol(a, k) != _symbol(b, k)).cast("int") for k in range(SYMBOLS)), F.lit(0))


def _bitmap(places: np.ndarray) -> list[int]:
    """LONGS longs with a bit for each place, modulo their number of bits."""
    bits = np.zeros(64 * LONGS, bool)
    bits[(places & (64 * LONGS - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view("<i8").tolist()


def _against_hub(percent: int, list_lacking: bool):
    """Over rows sorted by hub, the hub's own text first: what each member has of the hub.

    linked: full sets are alike enough. n, held: size of the member's set and what of it the hub has. lacking: the
    shingles that the hub lacks, if asked for. reaches: the n - ceil(percent n / 100) + 1 shingles of which any set that
    is alike enough must have one, taken from those that the hub lacks first, go on into the hub's shingles. bits: if
    asked for, the bitmap of the hub's shingles that the member misses, then that of its own that the hub lacks.
    """
    def run(batches):
        hub = own = None
        for batch in batches:
            out = [[], [], [], [], [], [], [], []]
            hubs, members = batch.column("hub").to_pylist(), batch.column("member").to_pylist()
            for h, m, s in zip(hubs, members, shingle_sets(unpacked(batch.column("packed")))):
                if h == m:
                    hub, own = h, s
                elif h == hub:
                    at = np.minimum(np.searchsorted(own, s), len(own) - 1)
                    has = own[at] == s
                    n, held = len(s), int(has.sum())
                    prefix = n + percent * n // -100 + 1
                    lacking, bits = [], []
                    if list_lacking:
                        missed = np.ones(len(own), bool)
                        missed[at[has]] = False
                        lacking, bits = s[~has].view(np.int64), _bitmap(np.flatnonzero(missed)) + _bitmap(s[~has])
                    for c, v in zip(out, (h, m, 100 * held >= percent * (len(own) + n - held), n, held, lacking,
                                          n - held < prefix, bits)):
                        c.append(v)
                else:
                    raise ValueError(f"text of {h} is missing")
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                             names=["hub", "member", "linked", "n", "held", "lacking", "reaches", "bits"])
    return run


def against_hubs(pairs: DataFrame, texts: DataFrame, percent: int, list_lacking: bool = False) -> DataFrame:
    """The rows of ``_against_hub`` for distinct (hub, member) pairs. ``texts``: (_doc, packed).

    Members are dealt out by hub and a salt, SPREAD members a salt, each salt with a copy of the hub's text, and pass
    by one at a time: a task holds two sets, however many members a hub has.
    """
    p = pairs.distinct()
    spread = p.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / SPREAD).cast("long").alias("salts"))
    p = p.join(spread, "hub").select("hub", "member", F.pmod(F.xxhash64("member"), F.col("salts")).alias("salt"))
    own = spread.select("hub", F.col("hub").alias("member"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    rows = p.unionByName(own).join(texts.withColumnRenamed(KEY, "member"), "member")
    rows = rows.select("hub", "salt", "member", "packed", (F.col("hub") != F.col("member")).alias("later"))
    rows = rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "later")
    return rows.select("hub", "member", "packed").mapInArrow(
        _against_hub(percent, list_lacking), "hub long, member long, linked boolean, n long, held long, "
        "lacking array<long>, reaches boolean, bits array<long>")


def still_open(seen: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``_against_hub``, with labels, of the hubs whose members are in several components."""
    label = lambda c, alias: labels.select(F.col("v").alias(c), F.col("label").alias(alias))
    m = (seen.join(label("member", "label"), "member", "left").join(label("hub", "hub_label"), "hub", "left")
         .withColumn("label", F.coalesce("label", "member")).withColumn("hub_label", F.coalesce("hub_label", "hub")))
    open_ = m.groupBy("hub").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("hub")
    return stored(m.join(open_, "hub"), "open")


def recentred(m: DataFrame) -> DataFrame:
    """(hub, member) pairs of the members of open hubs with their centre, the member that differs least from the hub."""
    centre = m.groupBy("hub").agg(F.max_by("member", F.struct(2 * F.col("held") - F.col("n"), -F.col("member"))).alias("centre"))
    return (m.join(centre, "hub").where("member <> centre").select(F.col("centre").alias("hub"), "member").distinct())


def remaining_pairs(m: DataFrame, percent: int) -> DataFrame:
    """(hub, member) pairs of members of one hub, in different components, that may be alike enough.

    ``m``: rows of ``still_open`` with lists and bitmaps. The overlap that a link needs is percent / (100 + percent) of both
    sizes; what two members share is counted apart for what the hub holds of them and for the rest.
    How often members lack a shingle, and whether in one component only, is a map-side combined count; a member's list
    of what its hub lacks is bounded by its text.
    """
    enough = lambda most: most * (100 + percent) >= percent * (F.col("n") + F.col("n_b"))
    sizes = 100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b")
    apart = (F.col("member") != F.col("member_b")) & (F.col("label") != F.col("label_b")) & sizes

    longs = [f"b{k}" for k in range(2 * LONGS)]
    m = m.select("*", *[F.get("bits", F.lit(k)).alias(c) for k, c in enumerate(longs)])
    only = lambda of, x, y: sum((F.bit_count(F.col(c + x).bitwiseAND(F.bitwise_not(c + y))) for c in of), F.lit(0))
    missed, lacked = longs[:LONGS], longs[LONGS:]
    # what one misses of the hub and the other does not is held by the other alone
    held = F.least(F.col("held") - only(missed, "_b", ""), F.col("held_b") - only(missed, "", "_b"))

    smallest = m.groupBy("hub").agg(F.min("n").alias("low"))
    own = ("member", "label", "n", "held", *longs)
    t = m.join(smallest, "hub").select("hub", "member", "n", "low", F.explode("lacking").alias("shingle"), "label")
    seen_in = t.groupBy("hub", "shingle").agg(F.count(F.lit(1)).alias("f"), (F.min("label") != F.max("label")).alias("across"))
    # rare shingles first; a partner has one of the first n - overlap + 1, with the least overlap that its size allows
    least = F.greatest("low", F.ceil(F.col("n") * percent / 100))
    prefix = F.col("n") - F.ceil((F.col("n") + least) * percent / (100 + percent)) + 1
    t = (t.join(seen_in, ["hub", "shingle"]).groupBy("hub", "member", "n", "low")
         .agg(F.sort_array(F.collect_list(F.struct("f", "shingle", "across"))).alias("list"))
         .select("hub", "member", F.posexplode(F.slice("list", F.lit(1), F.greatest(prefix, F.lit(0)).cast("int"))).alias("at", "s"))
         .where("s.across").select("hub", "member", "at", "s.shingle"))
    t = t.join(m.select("hub", *own), ["hub", "member"])
    u = t.select("hub", "shingle", *[F.col(c).alias(f"{c}_b") for c in (*own, "at")])
    # of what the hub lacks they share nothing before this shingle
    rest = F.least(F.col("n") - F.col("held") - F.greatest(F.col("at"), only(lacked, "", "_b")),
                   F.col("n_b") - F.col("held_b") - F.greatest(F.col("at_b"), only(lacked, "_b", "")))
    by_shingle = t.join(u, ["hub", "shingle"]).where(apart & (F.col("member") < F.col("member_b")) & enough(held + rest))

    # the members of a hub that reach it, dealt out by salts; those of other components than the hub's go to each
    r = m.where("reaches").select("hub", "hub_label", *own)
    r = r.join(r.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / SPREAD).cast("long").alias("salts")), "hub")
    s = r.select("hub", F.pmod(F.xxhash64("member"), F.col("salts")).alias("salt"), *[F.col(c).alias(f"{c}_b") for c in own])
    r = r.where("label <> hub_label").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    by_hub = r.join(s, ["hub", "salt"]).where(apart & enough(held))
    pair = (F.least("member", "member_b").alias("hub"), F.greatest("member", "member_b").alias("member"))
    return by_shingle.select(*pair).unionByName(by_hub.select(*pair)).distinct()


def _links(seen: DataFrame) -> DataFrame:
    return seen.where("linked").select(F.col("hub").alias("a"), F.col("member").alias("b"))


def _joined(labels: DataFrame, more: DataFrame) -> DataFrame:
    """Labels of components after more links."""
    if more.isEmpty():
        return labels
    return components(labels.select(F.col("v").alias("a"), F.col("label").alias("b")).unionByName(more))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(_doc, n_shingles, component, class, n_links): documents linked where 100 * intersection >= percent * union.

    ``docs``: (_doc, text), unique ids. ``component`` is the smallest id that links reach, ``class`` the smallest id
    with the same shingle set. A text without words, or null, is linked with nothing.
    """
    sig = stored(signatures(docs), "signatures")
    classes = stored(sig.where("n > 0").groupBy("c1", "c2").agg(F.min(KEY).alias("rep"), F.first("n").alias("n"),
                                                                F.min("sig").alias("sig")), "classes")
    bands = classes.select("rep", F.explode(keys()).alias("key")).distinct()
    groups = bands.groupBy("key").agg(
        F.count(F.lit(1)).alias("m"), F.min("rep").alias("hub"), F.bit_xor(F.xxhash64("rep")).alias("x"),
        F.sum(F.xxhash64(F.lit(1), "rep").cast("decimal(20,0)")).alias("s")).where("m > 1")
    # keys with the same members count once
    groups = groups.groupBy("m", "hub", "x", "s").agg(F.min("key").alias("key"))
    members = stored(bands.join(groups.select("key", "hub"), "key"), "members")
    pairs = members.where("rep <> hub").select("hub", F.col("rep").alias("member"))
    there = members.select(F.col("rep").alias(KEY)).distinct()
    # neither side has a bound that would allow a broadcast
    texts = stored(packed(docs).join(there.hint("merge"), KEY, "left_semi"), "texts")
    seen = stored(against_hubs(pairs, texts, percent), "compared")
    labels = components(_links(seen))
    seen = stored(against_hubs(recentred(still_open(seen, labels)), texts, percent, True), "compared")
    labels = _joined(labels, _links(seen))
    pairs = stored(remaining_pairs(still_open(seen, labels), percent), "pairs")
    labels = _joined(labels, _links(stored(against_hubs(pairs, texts, percent), "compared")))
    by_class = classes.select("c1", "c2", "rep").join(labels.withColumnRenamed("v", "rep"), "rep", "left")
    by_class = by_class.select("c1", "c2", F.col("rep").alias("class"), F.coalesce("label", "rep").alias("component"))
    alone = F.col("n") == 0
    return (sig.select(KEY, "n", "c1", "c2").join(by_class, ["c1", "c2"], "left")
            .select(KEY, F.col("n").alias("n_shingles"), F.when(alone, F.col(KEY)).otherwise(F.col("component")).alias("component"),
                    F.when(alone, F.col(KEY)).otherwise(F.col("class")).alias("class")))


def op2_near_dedup(spark, sf_dir):
    """Near-duplicate groups of ``documents``: one row per doc_id."""
    d = near_duplicates(one_row_per_document(documents(spark, sf_dir)))
    return d.select(doc_id(), "n_shingles", doc_id("component").alias("component_id"),
                    (F.col(KEY) == F.col("component")).alias("kept"), doc_id("class").alias("class_id"))


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM both_ JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), class_ AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY l) AS class_id
  FROM (SELECT doc_id, list_sort(list(s)) AS l FROM sh GROUP BY doc_id)
)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(m.m, doc_id)) AS component_id,
       doc_id <= coalesce(m.m, doc_id) AS kept, coalesce(class_id, doc_id) AS class_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN class_ USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) m USING (doc_id)
"""
