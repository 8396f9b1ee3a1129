"""The signature-tree join against all pairs, with trees of several heights."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from vitrina.llm import jaccard_join as module
from vitrina.llm.common import KEY
from vitrina.llm.jaccard_join import bitmap_width, jaccard_join, op12_jaccard_join


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").encode().lower().decode()) if x]
    return {tuple(w[i:i + 4]) for i in range(max(len(w) - 3, 1))} if w else set()


def brute(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    by = {i: {j for j, t in sets.items() if j != i and s and t and 100 * len(s & t) >= percent * len(s | t)} for i, s in sets.items()}
    out = {}
    for i in sorted(sets):
        if i not in out:
            seen, todo = {i}, [i]
            while todo:
                todo += [k for k in by[todo.pop()] if k not in seen and not seen.add(k)]
            for k in seen:
                same = min(j for j in seen if sets[j] == sets[k])
                out[k] = (len(sets[k]), len(by[k]), same, i)
    return out


def texts(seed=5):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(4000)}"
    def near(base, changes):
        w = list(base)
        for _ in range(changes):
            k = r.randrange(len(w))
            w[k:k + r.randrange(2)] = [word()]
        return w
    rows = []
    for size, copies, changes in ((30, 12, 2), (90, 25, 4), (90, 60, 3), (400, 12, 14), (7, 10, 1), (3, 6, 1), (1200, 4, 30)):
        base = [word() for _ in range(size)]
        rows += [near(base, r.randrange(changes + 1)) for _ in range(copies)]
    passage = [word() for _ in range(40)]  # many texts share it
    rows += [[word() for _ in range(r.randrange(2, 12))] + passage + [word() for _ in range(r.randrange(4))] for _ in range(60)]
    rows += [[word() for _ in range(r.randrange(1, 80))] for _ in range(60)]
    rows = [" ".join(w) for w in rows]
    rows += [rows[0].upper(), rows[3] + " \n", rows[70], rows[70], None, "", "  \n", "one", "ONE", "one two", "a a a a a a a a", "a a a a"]
    r.shuffle(rows)
    return list(enumerate(rows, -20))


@pytest.mark.parametrize("fanout, spread, percent", [(6, 4, 85), (1, 0, 85), (2, 1, 92)])
def test_join_is_that_of_all_pairs(spark, monkeypatch, fanout, spread, percent):
    monkeypatch.setattr(module, "FANOUT_BITS", fanout)
    monkeypatch.setattr(module, "SPREAD_BITS", spread)
    rows = texts()
    d = spark.createDataFrame(rows, f"{KEY} long, text string").repartition(3)
    got = {r[KEY]: (r["n_shingles"], r["n_links"], r["class"], r["component"]) for r in jaccard_join(d, percent).collect()}
    assert got == brute(rows, percent)


def test_members_of_a_leaf_may_come_in_any_order():
    """A leaf that is compared with itself comes twice, and a shuffle orders neither time."""
    rows = texts()
    want = {i: v for i, v in brute(rows, 85).items() if v[1]}
    rows = [(i, t) for i, t in rows if t and t.split()]
    r = random.Random(3)
    for _ in range(3):
        own, again = r.sample(rows, len(rows)), r.sample(rows, len(rows))
        member = [i for i, _ in own + again]
        b = [None] * len(own) + [5] * len(again)
        z = zstandard.ZstdCompressor()
        batch = pa.RecordBatch.from_arrays([pa.array([5] * len(b)), pa.array([8] * len(b)), pa.array(b, pa.int64()), pa.array(member), pa.array([1] * len(b)),
                                            pa.array([z.compress(t.encode()) for _, t in own + again])], names=["a", "salt", "b", "member", "copies", "packed"])
        got = pa.Table.from_batches(module._compared(85)([batch])).to_pylist()
        assert {x["v"]: (x["links"], x["label"]) for x in got} == {i: (v[1], v[3]) for i, v in want.items()}


def test_rows_without_an_id_of_their_own(spark, tmp_path):
    rows = [(7, "a b c d e"), (7, "other words here"), (None, "A b c d e"), (None, None), (3, "a b c d e"), (9, "other words here")]
    d = spark.createDataFrame([(i, t, "own", 1) for i, t in rows], "doc_id long, text string, rep string, n long")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op12_jaccard_join(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([(7, 2, None, None, 2), (7, 1, 7, 7, 1), (None, 2, None, None, 2), (None, 0, None, None, 0), (3, 2, None, None, 2),
                          (9, 1, 7, 7, 1)], key=str)


def test_no_rows(spark):
    assert jaccard_join(spark.createDataFrame([], f"{KEY} long, text string")).collect() == []


def test_bitmaps_are_wide_enough():
    for n in (1, 2, 31, 32, 33, 1000, 19_999):
        of = int(np.floor(module.BANDS * np.log2(n) + 1e-9))
        assert bitmap_width(of) >= n
        assert of - int(np.floor(module.BANDS * np.log2(max(1, -(-84 * n // 100))) + 1e-9)) <= module.NEAR


def test_shingles_that_cannot_link_make_no_members(spark, monkeypatch):
    """Short texts within long ones share shingles early in their order, but no two sets of such sizes can be linked."""
    stored, count = module.stored, {}

    def counted(df, name):
        out = stored(df, name)
        count[name] = out.count()
        return out
    monkeypatch.setattr(module, "stored", counted)
    monkeypatch.setattr(module, "rarity", lambda sketch: np.zeros(module.CELLS, np.uint16))
    rows = []
    for k in range(40):
        own = [f"t{k}w{i}" for i in range(60)]
        rows += [" ".join(own), " ".join(own[20:24])]
    d = spark.createDataFrame(list(enumerate(rows)), f"{KEY} long, text string")
    assert {tuple(r) for r in jaccard_join(d).collect()} == {(i, n, 0, i, i) for i, n in zip(range(80), [57, 1] * 40)}
    assert count["members"] == count["roots"] == 0


def test_linking_keeps_what_may_be_the_first_in_common(spark):
    """Of two holders both are judged, of more only whether one can be the smaller set."""
    rows = [(1, 10, 1, 0, 7), (2, 11, 1, 0, 7), (3, 10, 1, 0, 8), (4, 40, 1, 0, 8), (5, 20, 1, 3, 9), (6, 20, 1, 2, 9), (7, 9, 1, 0, 10),
            (1, 10, 1, 1, 11), (3, 10, 1, 0, 11), (4, 40, 1, 5, 11)]
    d = spark.createDataFrame(rows, "rep long, n long, copies long, at int, token long")
    got = {(r["token"], r["rep"], r["df"], r["most"], r["serves"]) for r in module.linking(d, 85).collect()}
    assert got == {(7, 1, 2, 10, True), (7, 2, 2, 11, True), (11, 1, 3, 9, False), (11, 3, 3, 10, True), (11, 4, 3, 35, False)}
