"""N-gram Jaccard join by signature trees.

Documents with the same shingle set are one class. Any global order of shingles serves to filter by prefixes: two sets
that are alike enough share one of the first n - ceil(percent n / 100) + 1 shingles of either. Here that order is rare
shingles first, as far as a sketch of counts of fixed size tells frequent ones, and then by hash. A class belongs to the tree of its home,
the prefix shingle that most other classes share with it, and there to a leaf of its size band. A node has about
2^FANOUT_BITS children; it holds the OR of their token bitmaps and their range of sizes, up to one root a home and band.

Pairs of roots that share a prefix shingle, early enough in their sets to be the first one in common of sets that are alike
enough, are traversed together, level by level. Two sets below a pair of nodes have at
most as many shingles in common as their bitmaps have bits, and those that fell on one bit in a set; where that, or the
sizes, can't make a link, the pair goes. Pairs of leaves that are left are compared on full sets. Each gives every class
its number of links and the smallest class of its component, so that a group of near copies makes no list of all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.common import KEY, NO_ID, ROWS, doc_id, documents, keyed_rows, map_batches, stored
from vitrina.llm.graph import components
from vitrina.llm.textbytes import encoded, packed, shingle_sets, unpacked

#: Size bands a doubling, and how far apart sizes that are alike enough can be.
BANDS = 16
NEAR = 5
#: Words of a shingle, and children of a node as a power of two.
WORDS, FANOUT_BITS = 4, 6
#: Cells of the sketch of counts, and of one row of it.
CELLS, CELL_ROW = 1 << 21, 1 << 13
_CELL_SHIFT = np.uint64(43)
#: Neighbouring leaves that are compared with one copy of a leaf in one task, as a power of two.
SPREAD_BITS = 4


def sketched(docs: DataFrame) -> DataFrame:
    """Over (_doc, text) two kinds of rows: (_doc, n, c1, c2), size and 128-bit digest of each shingle set, and (at, cells),
    how many shingles of a task fell on the CELL_ROW cells from ``at``."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = [KEY, "n", "c1", "c2", "at", "cells"]

    def rows(batches):
        cells = None
        for batch in batches:
            cells = np.zeros(CELLS, np.uint32) if cells is None else cells
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                size, digest = [], []
                for s in shingle_sets(encoded(part.column(1)), WORDS):
                    size.append(len(s))
                    digest.append(xxhash.xxh3_128_digest(s.tobytes()))
                    np.add.at(cells, s >> _CELL_SHIFT, 1)
                c = np.frombuffer(b"".join(digest), ">i8").astype(np.int64).reshape(-1, 2)
                none = [pa.nulls(len(size), k) for k in kinds[4:]]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(size, kinds[1]), pa.array(c[:, 0]), pa.array(c[:, 1]), *none],
                                                 names=names)
        if cells is not None:
            z = zstandard.ZstdCompressor(level=1)
            own = [z.compress(cells[k:k + CELL_ROW].tobytes()) for k in range(0, CELLS, CELL_ROW)]
            none = [pa.nulls(len(own), k) for k in kinds[:4]]
            yield pa.RecordBatch.from_arrays([*none, pa.array(range(0, CELLS, CELL_ROW), kinds[4]), pa.array(own, kinds[5])], names=names)
    return docs.select(KEY, "text").mapInArrow(rows, f"{KEY} long, n long, c1 long, c2 long, at long, cells binary")


def rarity(sketch: DataFrame) -> np.ndarray:
    """The rank of each cell's count among all cells, in two bytes a cell. A prefix takes the shingles of the least filled
    cells; a shingle that fills its cell by more than chance does is hardly ever among them, at any size of the table.
    Executors add the tasks' rows up; a few MB come here."""
    def rows(batches):
        total = {}
        z = zstandard.ZstdDecompressor()
        for b in batches:
            for at, cells in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = np.frombuffer(z.decompress(cells), np.uint32).astype(np.uint64)
                total[at] = own if at not in total else total[at] + own
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([t.tobytes() for t in total.values()], pa.binary())],
                                             names=["at", "total"])
    out = np.zeros(CELLS)
    for r in sketch.where("at is not null").select("at", "cells").repartition("at").mapInArrow(rows, "at long, total binary").collect():
        out[r["at"]:r["at"] + CELL_ROW] = np.frombuffer(r["total"], np.uint64)
    values, place = np.unique(out, return_inverse=True)
    rank = np.cumsum(np.bincount(place, minlength=len(values))) - 1  # equal counts have equal ranks
    return (rank[place] * 65535 // (CELLS - 1)).astype(np.uint16)


def prefixes(docs: DataFrame, order: np.ndarray, percent: int) -> DataFrame:
    """(_doc, prefix): the shingles of which any set that is alike enough has one."""
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for s in shingle_sets(encoded(batch.column(1)), WORDS):
            n = len(s)
            first = np.argsort(order[s >> _CELL_SHIFT], kind="stable")[:n + percent * n // -100 + 1 if n else 0]
            out.append(s[first].view(np.int64))
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(out, pa.list_(pa.int64()))], names=[KEY, "prefix"])
    return map_batches(docs.select(KEY, "text"), rows, f"{KEY} long, prefix array<long>")


def linking(tokens: DataFrame, percent: int) -> DataFrame:
    """Of (rep, n, copies, at, token) the shingles that two classes have, without those that can't be the first one that
    sets alike enough have in common, with ``df`` (classes that have it), ``most`` and ``serves``.

    ``most`` is what a set has in common at most with one that shares this shingle and none before it. The smaller set of
    a link has ``most`` for a set of its own size at least (``serves``); where two classes alone have a shingle, their sizes
    tell too. All of it comes from one shuffle of the shingles.
    """
    own = tokens.withColumn("most", F.col("n") - F.col("at"))
    own = own.withColumn("serves", F.col("most") * (100 + percent) >= 2 * percent * F.col("n"))
    holders = Window.partitionBy("token")
    own = own.select("*", F.count(F.lit(1)).over(holders).alias("df"), F.max("serves").over(holders).alias("_serves"),
                     F.min("most").over(holders).alias("_most"), F.sum("n").over(holders).alias("_n"))
    own = own.where("df > 1 and _serves").where((F.col("df") > 2) | (F.col("_most") * (100 + percent) >= percent * F.col("_n")))
    return own.drop("at", "_serves", "_most", "_n")


def band(n: str) -> Column:
    """Sizes that are alike enough (from 0.84) are at most NEAR bands apart."""
    return F.floor(BANDS * F.log2(F.col(n)) + 1e-9)


def bitmap_width(of: int) -> int:
    """Bits for the sets of a band: a power of two, one a shingle at least."""
    return max(64, 1 << int(np.ceil((of + 1) / BANDS)))


_NODE = "node long, home long, band long, no long, lo long, hi long, m long, extra long, bits binary"


def _signatures(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A node for each member: its bitmap, and how many of its shingles share a bit with another."""
    extra, bits = [], []
    for of, n, s in zip(batch.column("band").to_pylist(), batch.column("lo").to_pylist(), shingle_sets(unpacked(batch.column("packed")), WORDS)):
        own = np.zeros(bitmap_width(of), bool)
        own[(s & np.uint64(len(own) - 1)).astype(np.int64)] = True
        extra.append(n - int(own.sum()))
        bits.append(np.packbits(own, bitorder="little").tobytes())
    cols = [batch.column(c) for c in ("node", "home", "band", "no", "lo", "hi", "m")]
    return pa.RecordBatch.from_arrays([*cols, pa.array(extra, pa.int64()), pa.array(bits, pa.binary())],
                                      names=["node", "home", "band", "no", "lo", "hi", "m", "extra", "bits"])


def _combined(batches):
    """Over rows sorted by node: one row a node, the OR of its children's bitmaps with the ranges."""
    names = ["node", "home", "band", "no", "lo", "hi", "m", "extra", "bits"]
    kinds = [*([pa.int64()] * 8), pa.binary()]
    now = None
    for b in batches:
        out = []
        for r in zip(*(b.column(c).to_pylist() for c in names)):
            if now is not None and r[0] == now[0]:
                now = [*now[:4], min(now[4], r[4]), max(now[5], r[5]), now[6] + r[6], max(now[7], r[7]),
                       (np.frombuffer(now[8], np.uint8) | np.frombuffer(r[8], np.uint8)).tobytes()]
            else:
                out += [now] if now is not None else []
                now = list(r)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 9, kinds)], names=names)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(now, kinds)], names=names)


def _number(no: Column, level: int) -> Column:
    return F.xxhash64("home", "band", no, F.lit(level))


def tree(members: DataFrame) -> list[DataFrame]:
    """The nodes of each level, leaves first, of (node, home, band, no, n, packed); a level above has a node for
    2^FANOUT_BITS numbers of the one below, the last one root a home and band."""
    one = members.select("node", "home", "band", "no", F.col("n").alias("lo"), F.col("n").alias("hi"), F.lit(1).cast("long").alias("m"), "packed")
    rows = map_batches(one, _signatures, _NODE)
    out = []
    while True:
        rows = rows.repartition("node").sortWithinPartitions("node").mapInArrow(_combined, _NODE)
        up = F.shiftright("no", FANOUT_BITS)
        nodes = stored(rows.withColumn("parent", _number(up, len(out) + 1)), "nodes")
        out.append(nodes)
        if not nodes.agg(F.max("no")).first()[0]:
            return out
        rows = nodes.select(F.col("parent").alias("node"), "home", "band", up.alias("no"), "lo", "hi", "m", "extra", "bits")


def _possible(percent: int):
    """Of pairs of nodes those below which two sets may have enough in common."""
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for bits_a, bits_b, extra_a, extra_b, hi_a, hi_b, least in zip(*(batch.column(c).to_pylist() for c in (
                "bits_a", "bits_b", "extra_a", "extra_b", "hi_a", "hi_b", "least"))):
            a, b = np.frombuffer(bits_a, np.uint8), np.frombuffer(bits_b, np.uint8)
            extra = min(extra_a, extra_b) if len(a) == len(b) else extra_a if len(a) < len(b) else extra_b
            while len(a) != len(b):  # the wider one is folded
                a, b = (a, b) if len(a) > len(b) else (b, a)
                a = a[:len(a) // 2] | a[len(a) // 2:]
            most = min(int(np.unpackbits(a & b).sum()) + extra, hi_a, hi_b)
            keep.append(most * (100 + percent) >= percent * least)
        return batch.select(["a", "b", "salt"]).filter(pa.array(keep, pa.bool_()))
    return rows


def pruned(pairs: DataFrame, nodes: DataFrame, on: str, percent: int) -> DataFrame:
    """(a, b, salt): the pairs of ``nodes`` that may have links below them, of those whose ``on`` (node or parent) are a
    pair (a, b). ``salt`` is the same for 2^SPREAD_BITS neighbours of b."""
    cols = ("node", "home", "band", "no", "lo", "hi", "m", "extra", "bits")
    side = lambda s: nodes.select(F.col(on).alias(s), *[F.col(c).alias(f"{c}_{s}") for c in cols])
    d = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    d = d.where("a <> b or node_a < node_b or (node_a = node_b and m_a > 1)")
    d = d.where((100 * F.col("hi_a") >= percent * F.col("lo_b")) & (100 * F.col("hi_b") >= percent * F.col("lo_a")))
    d = d.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"),
                 F.xxhash64("home_b", "band_b", F.shiftright("no_b", SPREAD_BITS)).alias("salt"),
                 "bits_a", "bits_b", "extra_a", "extra_b", "hi_a", "hi_b", (F.col("lo_a") + F.col("lo_b")).alias("least"))
    return map_batches(d, _possible(percent), "a long, b long, salt long")


def _linked(a: dict, b: dict, percent: int, same: bool) -> list[tuple[int, int, int]]:
    """(class, documents of the classes of the other leaf it links to, smallest class of its component) for two leaves."""
    join = lambda x: (np.concatenate(x["sets"]), np.repeat(np.arange(len(x["sets"])), [len(s) for s in x["sets"]]))
    (s, own_s), (t, own_t) = join(a), join(b)
    both = np.intersect1d(s, t)
    if not len(both):
        return []

    def matrix(tokens, own, k):
        out = np.zeros((k, len(both)), np.float32)
        at = np.minimum(np.searchsorted(both, tokens), len(both) - 1)
        hit = both[at] == tokens
        out[own[hit], at[hit]] = 1
        return out
    common = (matrix(s, own_s, len(a["sets"])) @ matrix(t, own_t, len(b["sets"])).T).astype(np.int64)
    size = lambda x: np.array([len(s) for s in x["sets"]])
    link = (100 + percent) * common >= percent * (size(a)[:, None] + size(b)[None, :])
    if same:
        np.fill_diagonal(link, False)
    reps_a, reps_b = np.array(a["reps"]), np.array(b["reps"])
    label_a, label_b = reps_a.copy(), reps_b.copy()
    top = np.iinfo(np.int64).max
    while True:  # the smallest class that links reach
        new_a = np.minimum(label_a, np.where(link, label_b[None, :], top).min(1))
        new_b = new_a if same else np.minimum(label_b, np.where(link, new_a[:, None], top).min(0))
        if (new_a == label_a).all() and (new_b == label_b).all():
            break
        label_a, label_b = new_a, new_b
    out = list(zip(reps_a.tolist(), (link @ np.array(b["copies"])).tolist(), label_a.tolist()))
    if not same:
        out += zip(reps_b.tolist(), (link.T @ np.array(a["copies"])).tolist(), label_b.tolist())
    return [r for r in out if r[1]]


def _compared(percent: int):
    """Over rows sorted by (a, salt, b), a's own members with b null first: links of a's members with those of each b. A leaf
    is compared with itself in one order, that of its own members: rows of one (a, salt, b) come in any order."""
    def run(batches):
        key = other = None
        own, there = {}, {}

        def found():
            return _linked(own, own, percent, True) if key[0] == other else _linked(own, there, percent, False)
        for batch in batches:
            out = []
            cols = [batch.column(c).to_pylist() for c in ("a", "salt", "b", "member", "copies")]
            for a, salt, b, member, copies, s in zip(*cols, shingle_sets(unpacked(batch.column("packed")), WORDS)):
                if other is not None and (b != other or (a, salt) != key):
                    out += found()
                    other = None
                if (a, salt) != key:
                    key, own = (a, salt), {"reps": [], "copies": [], "sets": []}
                if b is None:
                    x = own
                else:
                    if other is None:
                        other, there = b, {"reps": [], "copies": [], "sets": []}
                    x = there
                x["reps"].append(member)
                x["copies"].append(copies)
                x["sets"].append(s)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 3)], names=["v", "links", "label"])
        if other is not None and (out := found()):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["v", "links", "label"])
    return run


def compared(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(v, links, label) of pairs (a, b, salt) of leaves. A copy of a goes to each salt; a task holds two leaves."""
    cols = (F.col("rep").alias("member"), "copies", "packed")
    there = pairs.join(members.select(F.col("node").alias("b"), *cols), "b").select("a", "salt", "b", "member", "copies", "packed")
    own = pairs.select("a", "salt").distinct().join(members.select(F.col("node").alias("a"), *cols), "a")
    rows = own.select("a", "salt", F.lit(None).cast("long").alias("b"), "member", "copies", "packed").unionByName(there)
    rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b"))
    return rows.mapInArrow(_compared(percent), "v long, links long, label long")


def jaccard_join(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(_doc, n_shingles, n_links, class, component): documents linked where 100 * intersection >= percent * union of
    their sets of WORDS-word shingles. All links are found, up to equal 64-bit hashes of different shingles.

    ``docs``: (_doc, text), unique keys; ``percent`` from 84. ``n_links`` counts the documents linked with each, ``class``
    is the smallest key with the same set, ``component`` the smallest that links reach. Null text, or one without words,
    has the empty set, is linked with nothing and a class of its own.
    """
    if not 84 <= percent <= 100:
        raise ValueError("size bands hold from 84 percent")
    first = stored(sketched(docs), "sets")
    sets = first.where("at is null").drop("at", "cells")
    classes = stored(sets.where("n > 0").groupBy("c1", "c2").agg(F.min(KEY).alias("rep"), F.first("n").alias("n"),
                                                                 F.count(F.lit(1)).alias("copies")), "classes")
    found = prefixes(docs, rarity(first), percent).withColumnRenamed(KEY, "rep").join(classes.select("rep", "n", "copies"), "rep")
    found = stored(found, "prefixes")
    tokens = linking(found.select("rep", "n", "copies", F.posexplode("prefix").alias("at", "token")), percent)
    tokens = stored(tokens.withColumn("band", band("n")), "tokens")

    homes = tokens.groupBy("rep", "n", "copies", "band").agg(F.max(F.struct("serves", "df", F.col("token").alias("home"))).alias("h"))
    leaves = F.ceil(F.col("h.df") / (1 << FANOUT_BITS)).cast("long")
    homes = homes.select("rep", "n", "copies", "band", "h.home", F.pmod(F.xxhash64("rep"), leaves).alias("no"))
    homes = homes.withColumn("node", _number(F.col("no"), 0))
    # neither side has a bound that would allow a broadcast
    members = stored(packed(docs).withColumnRenamed(KEY, "rep").join(homes.hint("merge"), "rep"), "members")

    nodes = tree(members)
    root = members.select("rep", _number(F.lit(0).cast("long"), len(nodes) - 1).alias("root"))
    t = (tokens.select("rep", "n", "token", "band", "most", "serves").join(root, "rep").groupBy("token", "band", "root")
         .agg(F.max("most").alias("most"), F.min("n").alias("low"), F.max("serves").alias("serves")))
    t = stored(t, "roots")
    # the smaller set of a link has the first shingle in common where it serves; of roots of one band either may hold it
    wide = F.floor(F.col("band") / (NEAR + 1))  # bands near each other are in one wide band or in the next
    near = t.where("serves").select("token", F.col("band").alias("band_a"), F.col("root").alias("a"), F.col("most").alias("most_a"),
                                    F.col("low").alias("low_a"), F.explode(F.array(wide, wide + 1)).alias("wide"))
    pairs = near.join(t.drop("serves").withColumnRenamed("root", "b").withColumn("wide", wide), ["token", "wide"])
    pairs = pairs.where((F.col("band") - F.col("band_a")).between(0, NEAR) & (F.col("a") != F.col("b")))
    pairs = pairs.where(F.least("most_a", "most") * (100 + percent) >= percent * (F.col("low_a") + F.col("low")))
    swap = (F.col("band_a") == F.col("band")) & (F.col("a") > F.col("b"))
    pairs = pairs.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b")).distinct()
    # members of one root share its home: no shingles are needed to pair it with itself
    pairs = pairs.unionByName(nodes[-1].where("m > 1").select(F.col("node").alias("a"), F.col("node").alias("b")))
    pairs = pruned(pairs, nodes[-1], "node", percent)
    for level in reversed(nodes[:-1]):
        pairs = pruned(pairs, level, "parent", percent)
    pairs = stored(pairs, "pairs")

    seen = stored(compared(pairs, members, percent), "links")
    labels = components(seen.select(F.col("v").alias("a"), F.col("label").alias("b")))
    links = seen.groupBy("v").agg(F.sum("links").alias("links"))
    by_class = (classes.join(labels.withColumnRenamed("v", "rep"), "rep", "left").join(links.withColumnRenamed("v", "rep"), "rep", "left")
                .select("c1", "c2", F.col("rep").alias("class"), F.coalesce("label", "rep").alias("component"),
                        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    some = F.col("n") > 0
    return (sets.join(by_class, ["c1", "c2"], "left")
            .select(KEY, F.col("n").alias("n_shingles"), F.when(some, F.col("n_links")).otherwise(F.lit(0)).alias("n_links"),
                    F.when(some, F.col("class")).otherwise(F.col(KEY)).alias("class"),
                    F.when(some, F.col("component")).otherwise(F.col(KEY)).alias("component")))


def op12_jaccard_join(spark, sf_dir):
    """The join of ``documents`` with itself, a row for each of its rows; rows that share an id are documents each."""
    docs = keyed_rows(documents(spark, sf_dir), "text")
    ids = docs.select(KEY, "doc_id")
    d = jaccard_join(docs)
    if ids.where(F.coalesce("doc_id", F.lit(NO_ID)) != F.col(KEY)).isEmpty():  # keys are ids
        return d.select(doc_id(), "n_shingles", doc_id("component").alias("component_id"), doc_id("class").alias("class_id"), "n_links")
    d = stored(d, "joined")
    groups = d.select("class", "component").distinct()
    for c in ("class", "component"):
        groups = groups.join(ids.select(F.col(KEY).alias(c), F.col("doc_id").alias(f"{c}_id")), c)
    return (d.join(ids, KEY).join(groups, ["class", "component"])
            .select("doc_id", "n_shingles", "component_id", "class_id", "n_links"))


OP12_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM w WHERE len(w) > 0)
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
       coalesce(class_id, doc_id) AS class_id, coalesce(k.k, 0) AS n_links
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN class_ USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) m USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS k FROM link GROUP BY a) k USING (doc_id)
"""
