"""The ranked search against plain scoring, with blocks, bundles and owners of several sizes."""

import math
import random
import re

import pytest

from vitrina.llm import lexical_search
from vitrina.llm.lexical_search import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").encode().lower().decode())


def brute(docs, items, top):
    held = [(i, terms(t)) for i, t in docs]
    n_docs, total = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for item, t in items:
        asked.setdefault(item, set()).update(terms(t))
    out = []
    for item, own in asked.items():
        scores = []
        for i, w in held:
            m = 50 + (50 * len(w) * n_docs) // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * w.count(t)) // (1000 * w.count(t) + 20 * m))
                    for t in own if t in w)
            scores += [(-s, i)] if s else []
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out)


def corpus(n, seed=3):
    r = random.Random(seed)
    words = ["the", "The", "of", "À", "日本", "x1"] + [f"w{k}" for k in range(300)]
    odds = [300, 200, 200, 20, 20, 100] + [200 / (k + 1) for k in range(300)]
    text = lambda: r.choice([" ", "\n", "--"]).join(r.choices(words, odds, k=r.randrange(0, 60)))
    docs = [(r.randrange(-n, n), r.choice([text()] * 8 + [None, "", "...", "the of"])) for _ in range(n)]
    docs += [(n + k, "the same text w7 w8") for k in range(40)] + [(5 * n, "w1 " * 5000 + "end"), (-2 ** 63, "no id w2")]
    items = [(k, text()) for k in range(12)] + [(3, "w5 w6"), (20, None), (21, ""), (22, "unheard words only"), (23, "the THE of"),
                                               (24, "w7 w8"), (-2 ** 63, "w2 w3")]
    return docs, items


@pytest.mark.parametrize("block, bundle, owners", [(2048, 256, (0.01, 0.1)), (16, 4, (0.02, 0.2)), (50, 1, ())])
def test_ranks_are_those_of_brute_force(spark, monkeypatch, block, bundle, owners):
    monkeypatch.setattr(lexical_search, "BLOCK", block)
    monkeypatch.setattr(lexical_search, "BUNDLE", bundle)
    monkeypatch.setattr(lexical_search, "OWNERS", owners)
    docs, items = corpus(400)
    d = spark.createDataFrame(docs, "id long, text string").repartition(5)
    got = ranked(d, spark.createDataFrame(items, "item long, text string"), 10).collect()
    assert sorted(map(tuple, got)) == brute(docs, items, 10)


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None), (2, "..")], [(1, "a")])])
def test_nothing_to_rank(spark, docs, items):
    assert not ranked(spark.createDataFrame(docs, "id long, text string"), spark.createDataFrame(items, "item long, text string")).collect()
