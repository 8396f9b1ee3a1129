"""The Merkle manifest against a plain recursion, on awkward ids, groups and texts."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from vitrina.llm import merkle_manifest
from vitrina.llm.merkle_manifest import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, pos long, n long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute(rows):
    """{(doc_id, leaf): row} as the contract says it."""
    digest = lambda *fields: sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))
    low = lambda t: t and t.encode().lower().decode()
    groups = {}
    for i, text, lang, source, n, *_ in rows:
        hit = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        leaf = digest(i, source, lang, n, text)
        groups.setdefault(lang, []).append(((i is not None, i or 0), leaf, digest(i, source, lang, n, low(text)) if hit else leaf, i))

    def climb(nodes):
        """The last node, and the (left, right) siblings of each first one."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            runs = [nodes[k:k + 8] for k in range(0, len(nodes), 8)]
            for path, k in zip(paths, at):
                path.append(("".join(runs[k // 8][:k % 8]), "".join(runs[k // 8][k % 8 + 1:])))
            nodes, at = [sha(*r) for r in runs], [k // 8 for k in at]
        return nodes[0], paths

    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    own = {g: climb([x[1] for x in sorted(groups[g])]) for g in order}
    root, tops = climb([own[g][0] for g in order])
    out = []
    for g, top in zip(order, tops):
        for (_, leaf, now, i), path in zip(sorted(groups[g]), own[g][1]):
            h = now
            for left, right in path + top:
                h = sha(left, h, right)
            out.append((i, leaf, own[g][0], root, sha(*(a + b for a, b in path + top)), h, h == root))
    return sorted(out, key=str)


def got(spark, rows):
    d = spark.createDataFrame(rows, SCHEMA)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return sorted(map(tuple, manifest(d, hit, {"text": F.translate("text", upper, upper.lower())}).collect()), key=str)


def table(n, ids, langs, seed=1):
    r = random.Random(seed)
    text = lambda: r.choice([None, "", "Short", "ÀB c\n" * r.randrange(1, 40)])
    return [(i, text(), r.choice(langs), r.choice([None, "a", "b"]), r.choice([None, 3, 10 ** 12]), "x", 1, 2) for i in ids(r, n)]


def test_manifest_is_that_of_brute_force(spark):
    sparse = lambda r, n: [r.randrange(-2 ** 62, 2 ** 62) for _ in range(n)]
    rows = table(1300, lambda r, n: r.sample(range(-400, 3000), n), ["en", "en", "en", "en", "de", None, "", "é"])
    rows += table(40, sparse, ["zz", "one"], 2) + [(5, "A lone leaf", "lone", None, None, "", 0, 0)]
    rows += [(2 ** 63 - 1, "LAST", "en", "s", 4, "", 0, 0), (-2 ** 63 + 1, "first", "en", "s", 5, "", 0, 0)]
    assert got(spark, rows) == brute(rows)


def test_rows_that_share_an_id_are_leaves_each(spark):
    rows = table(700, lambda r, n: [r.choice([None, 7, 7, 7, k]) for k in range(n)], ["en", None], 3)
    rows += [(7, "same", "en", "a", 4, "", 0, 0)] * 30
    assert got(spark, rows) == brute(rows)


def test_many_groups(spark, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "DIRECTORY", (2, 3, 3))
    rows = table(900, lambda r, n: list(range(n)), [f"l{k}" for k in range(600)], 4)
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None, None, None, None)]])
def test_next_to_nothing(spark, rows):
    assert got(spark, rows) == brute(rows) if rows else got(spark, rows) == []
