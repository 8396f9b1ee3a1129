"""The operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vitrina.llm import mixing, near_dedup, suffix_dedup, text_classifier
from vitrina.llm.common import KEY, documents, keyed_rows, one_row_per_document, stored
from vitrina.llm.fingerprints import containment, distinct_count, merge, resemblance, with_sketch
from vitrina.llm.graph import components
from vitrina.llm.language_id import held_out, op3_language_id
from vitrina.llm.license_scan import SHINGLE, TEMPLATES, license_matches
from vitrina.llm.quality_rules import quality_rules
from vitrina.llm.queries import QUERIES
from vitrina.llm.sentencepiece_codec import MARK, Codec, encode_column, load_codec
from vitrina.llm.text_classifier import fitted, labelled_rows, usable_labels
from vitrina.sources.tables import read_table

WHITE = " \t\n\x0b\x0c\r"


def texts_of(spark, sf):
    return [tuple(r) for r in documents(spark, sf).select("doc_id", "text").collect()]


def frame(spark, rows):
    return spark.createDataFrame(rows, f"{KEY} long, text string")


# near-dedup

def shingles(text):
    w = text.encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows, percent=85):
    sets = {i: shingles(t or "") for i, t in rows}
    label = {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    x, y = sorted((top(i), top(j)))
                    label[y] = x
    return {i: (len(sets[i]), top(i)) for i in sets}


def family(n, words=120, seed=3, edits=4):
    """Texts that differ from one base in a few words, and chains of ever more edits."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10_000)}" for _ in range(words)]
    out, chain = [], list(base)
    for i in range(n):
        t = list(base)
        for _ in range(r.randrange(edits)):
            t[r.randrange(words)] = f"e{r.randrange(10_000)}"
        out.append(" ".join(t))
        chain[r.randrange(words)] = f"c{i}"
        out.append(" ".join(chain))
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_near_duplicates_are_those_of_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(near_dedup, "SPREAD", 3)
    cut = family(3, seed=20)[1].split()
    texts = family(40, seed=seed) + family(15, seed=9, edits=9) + ["a b c", "A  b\tC", "", None, "one"] * 2
    texts += [" ".join(cut[:n]) for n in range(60, 120, 2)]  # cut ends: parts of one long text, linked by length
    random.Random(seed).shuffle(texts)
    rows = list(enumerate(texts, 1))
    got = {r[KEY]: (r["n_shingles"], r["component"]) for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_signatures_within_the_threshold_share_a_key(spark):
    r = np.random.default_rng(1)
    rows = []
    for i in range(200):
        a = r.integers(0, 65536, near_dedup.SYMBOLS).astype(">u2")
        b = a.copy()
        b[r.choice(near_dedup.SYMBOLS, near_dedup.T, replace=False)] ^= 1
        rows.append((i, bytearray(a.tobytes()), bytearray(b.tobytes())))
    d = spark.createDataFrame(rows, "i int, sig binary, sig_b binary")
    got = d.select(near_dedup.distance("sig", "sig_b").alias("d"),
                   F.arrays_overlap(near_dedup.keys("sig"), near_dedup.keys("sig_b")).alias("met")).distinct().collect()
    assert [tuple(x) for x in got] == [(near_dedup.T, True)]


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)] + [(7, 530)]
    got = {r["v"]: r["label"] for r in components(spark.createDataFrame(path + star + [(3, 3)], "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 7 for i in range(500, 560)}}


# suffix-array dedup

def brute_repeats(rows, width=100):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            s = b[k:k + width]
            if s in seen:
                gone[k:k + width] = b"\1" * width
            seen.add(s)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[i] = (len(b), len(b) - len(kept), sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1])), kept)
    return out


@pytest.mark.parametrize("group", [2000, 3])
def test_repeats_are_those_of_brute_force(spark, sf, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    monkeypatch.setattr(suffix_dedup, "BATCH", 64)
    rows = texts_of(spark, sf) + [(-1, "a" * 700), (-2, None), (-3, ""), (-4, "ab" * 300 + "c" + "ab" * 90), (-5, "x" * 99),
                                  (-6, "é" * 150), (-7, "a" * 100), (-8, "b" * 101), (-9, "abc" * 33 + "a" + "abc" * 60)]
    got = {r[KEY]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
           for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert got == brute_repeats(rows)


# fingerprints

def test_fingerprints_follow_the_true_sets(spark, sf):
    rows = {i: t or "" for i, t in texts_of(spark, sf)}
    order = sorted(rows, reverse=True)
    got = {r["doc_id"]: r for r in QUERIES["op10_fingerprints"](spark, sf).collect()}
    worst = 0.0
    for i, j in zip(order, order[1:] + order[:1]):
        text, cut = rows[i], len(rows[i]) // 3
        edited = text[:len(text) - cut] + rows[j][:cut]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for name, other in (("near_edited", edited), ("near_next", rows[j])):
            a, b = (shingles(x.lower()) for x in (text, other))
            true = len(a & b) / len(a | b) if a | b else 1.0
            worst = max(worst, abs(got[i][name] - true))
    assert worst < 0.2  # k = 128: a standard error of at most 0.045


def test_sketches_merge(spark):
    w = [f"w{i}" for i in range(3000)]
    d = spark.createDataFrame([(" ".join(w[:2000]), " ".join(w[1000:]), " ".join(w))], "a string, b string, c string")
    for c in "abc":
        d = with_sketch(d, c, f"s{c}")
    a, b, c = (F.col(f"s{x}") for x in "abc")
    got = d.select(resemblance(a, c), containment(a, c), distinct_count(merge(a, b)), F.size(merge(a, b))).first()
    assert abs(got[0] - 2 / 3) < 0.15 and got[1] > 0.85 and abs(got[2] / 2996 - 1) < 0.3 and got[3] == 128


# language ID, licenses, quality, mixing, SentencePiece

def test_held_out_languages(spark, sf):
    d = op3_language_id(spark, sf).join(documents(spark, sf).select("doc_id", "lang", "text"), "doc_id")
    right = d.where("held_out and length(text) > 40").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97


def test_licenses_are_found_wherever_they_stand(spark):
    filler = [f"filler{i}" for i in range(400)]
    rows, want = [], {}
    for i, (name, notice) in enumerate(TEMPLATES.items()):
        for at in (0, 5, 131, 400):
            key = i * 1000 + at
            rows.append((key, " ".join(filler[:at] + [notice.upper()] + filler[at:])))
            want[key] = (name, at)
    rows += [(-1, "Released under the"), (-2, None), (-3, " ".join(filler))]
    got = {r[KEY]: {(m["license"], m["first_word"]) for m in r["matches"]} for r in license_matches(frame(spark, rows)).collect()}
    assert all(want[k] in got[k] for k in want)
    assert not (got[-1] or got[-2] or got[-3])


def test_every_occurrence_of_a_license_counts_once(spark):
    filler = [f"filler{i}" for i in range(120)]
    rows, want = [], []
    for name in ("MIT", "GPL-3.0", "Apache-2.0-header", "MIT-header"):
        notice = re.findall(r"[a-z0-9]+", TEMPLATES[name].lower())
        n = len(notice)
        for at in [*range(70), 120]:  # every place to a window's start
            rows.append(" ".join(filler[:at] + notice + filler[at:]))
            want.append((name, [(at, 1.0)]))
        for gap in (0, 1, 6):  # repeats, side by side too
            rows.append(" ".join(3 * (filler[:gap] + notice)))
            want.append((name, [(k * (gap + n) + gap, 1.0) for k in range(3)]))
        if n > 30:
            m = n - SHINGLE + 1
            rows.append(" ".join(filler[:9] + ["other"] + notice[1:] + filler))  # the first word is another one
            want.append((name, [(9, (m - 1) / m)]))
            rows.append(" ".join(filler[:9] + notice[:12] + ["two", "more"] + notice[12:] + notice))
            want.append((name, [(9, (m - 4) / m), (9 + n + 2, 1.0)]))
            rows.append(" ".join(notice[:n - 5] + notice[n // 2:]))  # the second start is cut
            want.append((name, [(0, (m - 5) / m)]))
            rows.append(" ".join(filler[:9] + notice[15:] + notice[:15]))  # halves in the other order
            want.append((name, [(9, (m - 4) / m)]))
    got = {r[KEY]: r["matches"] for r in license_matches(frame(spark, list(enumerate(rows)))).collect()}
    for i, (name, places) in enumerate(want):
        assert [(m["first_word"], m["containment"]) for m in got[i] if m["license"] == name] == places, (i, rows[i])


def test_quality_agrees_with_labels(spark, sf):
    d = QUERIES["op5_quality_classifier"](spark, sf).select("doc_id", "kept")
    d = d.join(read_table(spark, sf, "labels").where("quality is not null"), "doc_id")
    got = {(r["quality"], r["kept"]): r["count"] for r in d.groupBy("quality", "kept").count().collect()}
    assert got.get((1, False), 0) <= 0.02 * got[1, True] and got.get((0, True), 0) <= 0.35 * got[0, False]


def test_labels_without_a_usable_text_take_no_place(spark):
    r = random.Random(6)
    good, bad = (["calm", "clear", "plain", "exact"], ["click", "win", "free", "now"])
    text = lambda i: " ".join(r.choice(bad if i % 20 == 0 else good) for _ in range(r.randrange(20, 40)))
    docs = [(i, text(i)) for i in range(400)] + [(i, None) for i in range(400, 1000)] + [(i, "calm " * 4000) for i in range(1000, 1600)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.range(20_000).selectExpr("id as doc_id", "case when id % 20 = 0 then 'bad' else 'good' end as class")
    usable = usable_labels(d, labels)
    assert {r["doc_id"] for r in usable.collect()} == set(range(400))
    got = Counter(c for _, c in labelled_rows(d, usable, {"bad": 20, "good": 380}, 100))
    assert got == {"bad": 20, "good": 80}
    model = fitted(d, labels, ["bad", "good"], 100)
    p, _ = model.posteriors([b"win free click now " * 7, b"calm exact plain clear " * 7])
    assert p[0, 0] > 0.8 and p[1, 1] > 0.9


def test_mixture_meets_its_targets(spark):
    r = np.random.default_rng(5)
    p = r.dirichlet([2, 1, 0.5], 3000)
    words = r.integers(1, 2000, 3000)
    d = spark.createDataFrame([(int(w), [float(x) for x in row]) for w, row in zip(words, p)], "words long, posterior array<double>")
    targets = {"a": 0.6, "b": 0.38, "c": 0.02}
    steps = mixing.fit_rates(d, targets)
    rate = np.ones(3000)
    for u in steps:
        rate = np.maximum(0, rate - p @ u)
    have = (rate * words) @ p
    want = 1.05 * (words @ p)[0] / 0.6 * np.array([0.6, 0.38, 0.02])
    assert rate.min() >= 0 and np.abs(have - want).max() < 0.03 * want.sum()
    got = d.select(F.sum(mixing.rate_after(steps, [F.get("posterior", F.lit(i)) for i in range(3)]) * F.col("words"))).first()[0]
    assert abs(got - (rate * words).sum()) < 1e-6 * got


def test_codec_parity_and_round_trip(spark, sf):
    import sentencepiece
    codec = load_codec()
    other = sentencepiece.SentencePieceProcessor(model_proto=codec.data)
    texts = [t for _, t in texts_of(spark, sf)] + [
        "", " ", "  two  spaces ", "\n\n a\tb", "▁x▁▁y", "<s> </s> <unk> <0x0A>", "日本語 emoji 😀👩‍👩‍👧", "\0a\1 \0b", "a" * 3000,
        " ▁ ▁▁", "é é", "﻿bom", "ﬁ ½", "\r\n", "x ", "x  "]
    want = other.encode(texts)
    assert codec.encode(texts) == want
    assert codec.decode(want) == [t.replace(MARK, " ") for t in texts]
    for ids, good, same in codec.verified(texts):
        assert good and same
    assert [list(ids) for ids, _, _ in codec.verified(texts)] == want
    run = " " * 50 + "x"  # pieces of equal score: the libraries differ, the codec's ids count and are told apart
    ids, good, same = codec.verified([run])[0]
    assert list(ids) == codec.encode([run])[0] and good and same == (list(ids) == other.encode(run))
    assert codec.decode([list(map(int, ids))]) == [run]


def _field(number, value):
    """One protobuf field: int as varint, float as 4 bytes, else with its length."""
    def varint(n):
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    value = value.encode() if isinstance(value, str) else value
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram_model(byte_fallback):
    """A model file of a few pieces, written by hand."""
    bytes_ = [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)] if byte_fallback else []
    plain = [("▁", -2.0), ("a", -3.0), ("b", -3.1), ("n", -3.2), ("an", -3.5), ("ana", -5.2), ("▁ban", -4.0), ("▁b", -3.9), ("na", -3.4),
             ("ban", -6.0), ("▁▁", -4.5), ("é", -7.0), ("s", -4.1), ("as", -4.4)]
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *bytes_, *[(p, s, 1) for p, s in plain]]
    return (b"".join(_field(1, _field(1, p) + _field(2, s) + _field(3, t)) for p, s, t in pieces)
            + _field(2, _field(3, 1) + _field(4, len(pieces)) + _field(35, int(byte_fallback)))
            + _field(3, _field(1, "identity") + _field(3, 1) + _field(4, 0) + _field(5, 1)))


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_unigram_model(spark, byte_fallback):
    import sentencepiece
    codec = Codec(unigram_model(byte_fallback), threads=2)
    other = sentencepiece.SentencePieceProcessor(model_proto=codec.data)
    rng = random.Random(6)
    texts = ["banana", "bananas an  ban", "", " ", "é", *("".join(rng.choices("ban sé ", k=rng.randint(1, 40))) for _ in range(300))]
    texts += ["x日本 banana" + "z" * 3, "ban😀"] if byte_fallback else []
    want = other.encode(texts)
    found = codec.verified(texts)
    assert [list(i) for i, _, _ in found] == want == codec.encode(texts) and all(g and s for _, g, s in found)
    rows = encode_column(spark.createDataFrame([(t,) for t in texts], "text string"), codec).collect()
    assert {r["text"]: r["ids"] for r in rows} == dict(zip(texts, want)) and all(r["parity"] for r in rows)


def test_licenses_that_lost_words_are_found(spark):
    rng = random.Random(8)
    cut = lambda t: [w for w in re.split("[^a-z0-9]+", t.lower()) if w]
    grams = lambda w: [tuple(w[i:i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)]
    rows, want = [], set()
    for i in range(900):
        name = rng.choice(list(TEMPLATES))
        own = cut(TEMPLATES[name])
        at = rng.randint(0, 60)
        lost = rng.randint(0, 3)
        own = own[lost:] if rng.random() < 0.5 else own[:len(own) - lost]
        words = [f"f{rng.randint(0, 999)}" for _ in range(at)] + own + [f"g{rng.randint(0, 999)}" for _ in range(rng.randint(0, 60))]
        rows.append((i, " ".join(words)))
        have = set(grams(words))
        for other, text in TEMPLATES.items():
            of = set(grams(cut(text)))
            if len(of & have) >= 0.8 * len(of):
                want.add((i, other))
    got = {(r[KEY], m["license"]) for r in license_matches(frame(spark, rows)).collect() for m in r["matches"]}
    assert got == want and len(want) > 500


# pipeline

def brute_line_dedup(rows):
    holders = {}
    key = lambda line: line.strip(WHITE).encode().lower().decode()
    for i, t in rows:
        for k in {key(x) for x in t.split("\n")}:
            if len(k) >= 20:
                holders.setdefault(k, []).append(i)
    out = {}
    for i, t in rows:
        lines = t.split("\n")
        left = [x for x in lines if not (len(holders.get(key(x), [])) >= 3 and max(holders[key(x)]) != i)]
        if len(left) == len(lines) or "\n".join(left).strip(" "):
            out[i] = "\n".join(left)
    return out


def test_pipeline_stages_against_brute_force(spark, sf):
    d = documents(spark, sf)
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        d = stored(stage(spark, d, sf), name)
        results[name] = [r.asDict() for r in d.collect()]
    first, second, third, fourth, last = results.values()
    assert len(first) >= 0.99 * documents(spark, sf).count()  # clean documents stay
    lines = brute_line_dedup([(r["doc_id"], r["text"]) for r in first])
    assert {r["doc_id"]: r["text"] for r in second} == lines
    assert all(r["n_chars"] == len(r["text"]) for r in second)
    parts = brute_components(list(lines.items()), corpus_pipeline.ALIKE)
    assert {r["doc_id"] for r in third} == {i for i, (_, c) in parts.items() if i == c}
    ids = [r["doc_id"] for r in fourth]
    assert set(ids) <= {r["doc_id"] for r in third} and len(set(ids)) > 0.85 * len(third)
    assert sorted(r["doc_id"] for r in last) == sorted(ids)
    codec = load_codec()
    assert all(codec.encode([r["text"]])[0] == r["ids"] and r["parity"] and r["round_trip"] for r in last)


def test_repeated_rows_are_one_document(spark):
    d = spark.createDataFrame([(1, "b"), (1, "a"), (None, "x"), (None, None), (2, None)], "doc_id long, text string")
    got = sorted((r[KEY], r["text"]) for r in one_row_per_document(d).collect() if r["text"])
    assert got == [(-2 ** 63, "x"), (1, "b")]


def test_unlearned_languages_and_letter_junk_go(spark, sf):
    r = random.Random(2)
    junk = " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(3, 10))) for _ in range(200))
    other = [junk, "asdf jkl qwer uiop zxcv nm asdf ghjk qwerty", "a" * 500, "政府は昨日、新しい学校法が九月に施行されると発表した。",
             "Il governo ha annunciato ieri che la nuova legge sulla scuola entrerà in vigore a settembre, mentre i sindacati "
             "chiedono più tempo per discutere le modifiche proposte dalla commissione.",
             "De regering heeft gisteren aangekondigd dat de nieuwe wet op het onderwijs in september van kracht wordt, terwijl "
             "de vakbonden meer tijd vragen om de voorgestelde wijzigingen te bespreken.",
             "Правительство объявило вчера, что новый закон об образовании вступит в силу в сентябре."]
    d = documents(spark, sf).select(corpus_pipeline.COLUMNS)
    more = spark.createDataFrame([(-i, t, None, "x", len(t)) for i, t in enumerate(other, 1)], d.schema)
    got = {r["doc_id"] for r in corpus_pipeline.language_id(spark, d.unionByName(more), sf).collect()}
    held = {r["doc_id"] for r in d.where(held_out() & (F.length("text") > 40)).collect()}
    assert len(held) > 50 and held <= got
    assert not [i for i in got if i < 0]


def test_boilerplate_lines_leave_their_documents(spark):
    menu = "Home | About us | Contact and more"
    own = [f"own words of {i} " + " ".join(f"w{i}x{j}" for j in range(60)) for i in range(12)]
    rows = [(i, f"{menu}\n{t}\n\n  {menu.upper()} \nend of {i}", "a") for i, t in enumerate(own)]
    rows += [(100, menu, "a"), (101, menu + "\nanother host", "b"), (102, None, "a")]
    d = spark.createDataFrame(rows, f"{KEY} long, text string, source string")
    got = {r[KEY]: (r["n_lines_removed"], r["remaining"]) for r in quality_rules(d).collect()}
    assert got == {**{i: (2, f"{t}\n\nend of {i}") for i, t in enumerate(own)},
                   100: (1, ""), 101: (0, menu + "\nanother host"), 102: (0, "")}


def test_lines_are_common_at_every_size_of_a_host(spark):
    menu = "Home | About us | Contact and more of the same"
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    held = [(i, f"{menu}\n{own(i)}", "a") for i in range(11)] + [(20 + i, f"rare {menu}\n{own(i)}", "a") for i in range(10)]
    for more in (0, 20_000):
        rest = spark.range(100, 100 + more).select(F.col("id").alias(KEY), F.concat(F.lit("other text "), "id").alias("text"), F.lit("a").alias("source"))
        d = spark.createDataFrame(held, f"{KEY} long, text string, source string").unionByName(rest)
        got = quality_rules(d).where(F.col(KEY) < 100).select(KEY, "n_lines_removed").collect()
        assert dict(map(tuple, got)) == {**{i: 1 for i in range(11)}, **{20 + i: 0 for i in range(10)}}


def test_pipeline_rows_without_an_id_of_their_own_stay(spark, sf):
    rows = [r.asDict() for r in documents(spark, sf).select(corpus_pipeline.COLUMNS).collect()]
    want = {}
    for shared in (False, True):
        own = [{**r, "doc_id": (None, 7, r["doc_id"])[i % 3] if shared else i} for i, r in enumerate(rows)]
        d = spark.createDataFrame([tuple(r[c] for c in corpus_pipeline.COLUMNS) for r in own],
                                  documents(spark, sf).select(corpus_pipeline.COLUMNS).schema)
        for name, stage in corpus_pipeline.STAGES[1:3]:  # language ID learns from other rows if ids differ
            d = stored(stage(spark, d, sf), name)
            want.setdefault(name, []).append(d.count())
    assert want["near_dedup"][0] == want["near_dedup"][1] > 100
    assert abs(want["line_dedup"][0] - want["line_dedup"][1]) <= 2 and want["line_dedup"][1] > 150


def test_every_stage_reads_all_rows_without_an_id(spark, sf):
    texts = [r["text"] for r in documents(spark, sf).where("lang = 'en' and length(text) between 300 and 5000").limit(30).collect()]
    cols = documents(spark, sf).select(corpus_pipeline.COLUMNS)
    more = spark.createDataFrame([(None, t + f" {i}", "en", "x", len(t)) for i, t in enumerate(texts)], cols.schema)
    for name, stage in corpus_pipeline.STAGES[:2]:
        got = [r["text"] for r in stage(spark, cols.unionByName(more), sf).where("doc_id is null").collect()]
        assert len(got) >= 29, name


def test_row_keys_follow_ids_and_are_the_same_in_each_run(spark):
    rows = [(r, f"t{i % 50}") for i, r in enumerate([None] * 60 + [3] * 20 + [2, 9, -(2 ** 63)] * 5)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = [sorted((r[KEY], r["doc_id"], r["text"]) for r in keyed_rows(x, "text").collect()) for x in (d, d.repartition(7))]
    assert got[0] == got[1] and [r[0] for r in got[0]] == list(range(len(rows)))
    assert [r[1] for r in got[0]] == [None] * 60 + sorted(r[0] for r in rows[60:])


def test_contradicted_labels_are_not_learned_from():
    r = random.Random(8)
    words = {"good": ["calm", "clear", "plain", "exact"], "bad": ["click", "win", "free", "now"]}
    text = lambda c: " ".join(r.choice(words[c]) for _ in range(30))
    rows = [(text("good"), "good") for _ in range(300)] + [(text("bad"), "bad") for _ in range(60)]
    wrong = [(text("good"), "bad") for _ in range(25)] + [(text("bad"), "good") for _ in range(5)]
    every = rows + wrong + [("rare words", "rare")]
    r.shuffle(every)
    found = text_classifier.label_errors(every, ["good", "bad", "rare"], 5)
    assert {row for row, f in zip(every, found) if f} == set(wrong)


def test_tokenizer_takes_whole_texts():
    """The pipeline that gives the ids is the model's own, normaliser included; no words are cut from a text before it."""
    from vitrina.llm.sentencepiece_codec import load_codec
    codec = load_codec(threads=1)
    assert codec.tokenizer().pre_tokenizer is None and codec.tokenizer().normalizer is not None
    seen = []
    whole = codec.encode
    codec.encode = lambda texts: seen.extend(texts) or whole(texts)
    texts = ["Some words  again some words", "", " ▁x", "tab\tand\nline"]
    found = codec.verified(texts)
    assert seen == texts and all(r and p for _, r, p in found)


def test_tokenizer_decodes_without_a_pattern_and_in_the_tasks_thread(monkeypatch):
    """No regex runs over each token, no pool beside a task of one thread; markers are spaces wherever they stand."""
    import os

    import sentencepiece
    from vitrina.llm import sentencepiece_codec as module
    monkeypatch.setattr(module, "_built", {})
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    codec = module.load_codec(threads=1)
    assert "Replace" not in repr(codec.tokenizer().decoder) and os.environ["TOKENIZERS_PARALLELISM"] == "false"
    other = sentencepiece.SentencePieceProcessor(model_proto=codec.data)
    texts = ["a  b", "  a", "\u2581", "\u2581\u2581x \u2581", " ", "", "\u0e01\u2581\U0001f600 \n"]
    assert codec.encode(texts) == other.encode(texts)
    assert codec.decode(codec.encode(texts)) == [t.replace(MARK, " ") for t in texts]
    monkeypatch.setattr(module, "_built", {})
    module.load_codec(threads=2).tokenizer()
    assert os.environ["TOKENIZERS_PARALLELISM"] == "true"
