"""A softmax classifier on hashed words and a few text statistics, fitted on a bounded sample of labelled rows."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import KEY, map_batches, stored
from vitrina.llm.textbytes import SliceHash, chunks, encoded

DIMS = 1 << 16
#: Bound of the sample: rows, and bytes of a text that may be learned from.
TRAIN_ROWS, TRAIN_CHARS = 3000, 10_000
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_UPPER = np.isin(np.arange(256), range(0x41, 0x5B))
_DIGIT = np.isin(np.arange(256), range(0x30, 0x3A))
_MARKS = np.isin(np.arange(256), list(b"#*$%&|<>!"))


def features(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(distinct word places, statistics, words) of each text. Words are lower-cased runs of letters and digits; the
    third result counts words between white space."""
    places, stats, counts = [], [], []
    for lo, hi in chunks(texts):
        raw = np.frombuffer(b"\n".join(texts[lo:hi]) + b"\n", np.uint8)
        low = np.frombuffer(raw.tobytes().lower(), np.uint8)
        first = np.cumsum([0] + [len(t) + 1 for t in texts[lo:hi]])
        edge = np.diff(_WORD[low].astype(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        place = (SliceHash(low)(start, end) >> np.uint64(48)).astype(np.int64)
        at = np.searchsorted(start, first)
        sums = lambda flag: np.diff(np.concatenate([[0], np.cumsum(flag)])[first])
        n = np.maximum(np.diff(first) - 1, 1)
        begins = np.diff((~_SPACE[raw]).astype(np.int8), prepend=0) == 1
        begins[first[:-1]] |= ~_SPACE[raw[first[:-1]]]
        words = sums(begins)
        for k in range(hi - lo):
            own = np.unique(place[at[k]:at[k + 1]])
            places.append(own)
            found = max(at[k + 1] - at[k], 1)
            stats.append([len(own) / found ** 0.9, np.log1p(words[k])])
        share = [sums(t[raw]) / n for t in (_UPPER, _DIGIT, _MARKS, _SPACE)] + [sums(raw == 10) / np.maximum(words, 1)]
        stats[-(hi - lo):] = [a + [float(s[k]) for s in share] for k, a in enumerate(stats[-(hi - lo):])]
        counts += words.tolist()
    return places, np.array(stats).reshape(len(texts), 7), np.array(counts, np.int64)


@dataclass
class Model:
    classes: list[str]
    words: np.ndarray  # DIMS x classes
    stats: np.ndarray  # statistics and bias x classes
    mean: np.ndarray
    scale: np.ndarray

    def posteriors(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x classes, words of each text). Without anything to learn from all classes are alike."""
        places, stats, counts = features(texts)
        size = np.array([len(p) for p in places])
        out = np.zeros((len(texts), len(self.classes)))
        if len(texts):
            flat = np.concatenate([*places, [0]])  # reduceat needs a last element
            sums = np.add.reduceat(self.words[flat], np.cumsum([0, *size[:-1]]))
            out = np.where(size[:, None] > 0, sums, 0) + ((stats - self.mean) / self.scale) @ self.stats[:-1] + self.stats[-1]
        out = np.exp(out - out.max(1, keepdims=True, initial=-1e9))
        return out / np.maximum(out.sum(1, keepdims=True), 1e-300), counts


def fit(rows: list[tuple[str, str]], classes: list[str], steps: int = 150, l2: float = 3.0, least: int = 4) -> Model:
    """Softmax regression by Adam on (text, class) rows; words in fewer than ``least`` rows have no weight. Classes
    without rows keep a low prior."""
    k = len(classes)
    places, stats, _ = features([t.encode() for t, _ in rows])
    mean, scale = (stats.mean(0), stats.std(0) + 1e-9) if rows else (np.zeros(7), np.ones(7))
    words, w = np.zeros((DIMS, k), np.float32), np.zeros((8, k))
    if not rows:
        return Model(classes, words, w, mean, scale)
    y = np.array([classes.index(c) for _, c in rows])
    x = np.hstack([(stats - mean) / scale, np.ones((len(rows), 1))])
    seen = np.bincount(np.concatenate(places), minlength=DIMS)
    used = np.flatnonzero(seen >= least)
    index = np.full(DIMS, -1)
    index[used] = np.arange(len(used))
    own = [index[p][index[p] >= 0] for p in places]
    col, row = np.concatenate(own), np.repeat(np.arange(len(rows)), [len(o) for o in own])
    v = np.zeros((len(used), k))
    target = np.eye(k)[y]
    w[-1] = np.log(target.sum(0) + 0.5)
    moments = [[np.zeros_like(v), np.zeros_like(v)], [np.zeros_like(w), np.zeros_like(w)]]
    for step in range(1, steps + 1):
        z = x @ w
        for c in range(k):
            z[:, c] += np.bincount(row, v[col, c], len(rows))
        p = np.exp(z - z.max(1, keepdims=True))
        err = p / p.sum(1, keepdims=True) - target
        grads = [np.stack([np.bincount(col, err[row, c], len(used)) for c in range(k)], 1) + l2 * v,
                 x.T @ err + np.vstack([l2 * w[:-1], np.zeros((1, k))])]
        for a, g, (m1, m2) in zip((v, w), grads, moments):
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            a -= 0.05 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    words[used] = v
    return Model(classes, words, w, mean, scale)


def label_errors(rows: list[tuple[str, str]], classes: list[str], folds: int) -> np.ndarray:
    """Which (text, class) rows the other rows contradict: by a model of the other folds their class is less likely than
    its share of all rows, so that the text speaks against it, and another is the likeliest. Classes with fewer rows than
    folds are left alone."""
    y = np.array([classes.index(c) for _, c in rows])
    fold = np.arange(len(rows)) % folds
    held = np.zeros((len(rows), len(classes)))
    for f in range(folds):
        model = fit([r for r, k in zip(rows, fold) if k != f], classes)
        held[fold == f] = model.posteriors([t.encode() for (t, _), k in zip(rows, fold) if k == f])[0]
    count = np.bincount(y, minlength=len(classes))
    against = held[np.arange(len(y)), y] < count[y] / len(y)
    return (count[y] >= folds) & against & (held.argmax(1) != y)


def usable_labels(docs: DataFrame, labels: DataFrame, chars: int = TRAIN_CHARS) -> DataFrame:
    """(doc_id, class) of the labelled ids with a text of at most ``chars`` characters, one row an id: an id with several
    labels has the smallest. Only ids are shuffled."""
    once = labels.where("doc_id is not null and class is not null").groupBy("doc_id").agg(F.min("class").alias("class"))
    return once.join(docs.where(F.length("text") <= chars).select("doc_id"), "doc_id", "left_semi")


def labelled_rows(docs: DataFrame, usable: DataFrame, counts: dict[str, int], rows: int = TRAIN_ROWS,
                  chars: int = TRAIN_CHARS) -> list[tuple[str, str]]:
    """At most ``rows`` (text, class) pairs of (doc_id, text) joined to ``usable`` (doc_id, class) with ``counts`` rows a
    class. Classes get rows in turn as long as they have any, picked by a hash of the id.

    Ids are picked first (the sample, a few KB, is what is broadcast), so whole texts are not shuffled. An id with
    several texts has the smallest.
    """
    quota, left = {}, rows
    for i, (name, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):  # what a class lacks others get
        quota[name] = min(n, left // (len(counts) - i))
        left -= quota[name]
    picked = None
    for name, n in quota.items():  # a few classes
        own = usable.where(F.col("class") == name).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        picked = own if picked is None else picked.unionByName(own)
    if picked is None:
        return []
    found = (docs.select("doc_id", "text").where(F.length("text") <= chars)
             .join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("class").alias("class")))
    return [(r["text"], r["class"]) for r in found.orderBy("doc_id").collect()]


def fitted(docs: DataFrame, labels: DataFrame, classes: list[str], rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS,
           folds: int = 0) -> Model:
    """The model of (doc_id, text) with labels (doc_id, class). Where the sample has other shares of the classes than the
    usable labels, the model's prior is moved to theirs. With ``folds``, rows of the sample that ``label_errors`` finds
    are not learned from."""
    usable = stored(usable_labels(docs, labels, chars), "usable")
    counts = {r["class"]: r["count"] for r in usable.groupBy("class").count().collect()}
    sample = labelled_rows(docs, usable, counts, rows, chars)
    if counts and not sample:
        raise ValueError(f"{sum(counts.values())} labelled documents, but none in the sample")
    wrong = label_errors(sample, classes, folds) if folds and len(sample) >= folds else np.zeros(len(sample), bool)
    model = fit([row for row, w in zip(sample, wrong) if not w], classes)
    have = Counter(c for _, c in sample)
    if have != counts:
        for i, c in enumerate(classes):
            if have[c]:
                model.stats[-1, i] += np.log(counts[c] / have[c] * len(sample) / sum(counts.values()))
    return model


def scored(docs: DataFrame, model: Model, *carried: str) -> DataFrame:
    """(_doc, words, posterior, carried string columns) of (_doc, text, carried...); ``posterior`` is in the order of
    the model's classes."""
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        p, counts = model.posteriors(encoded(batch.column(1)))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()), pa.array(p.ravel()))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), lists, *batch.columns[2:]],
                                          names=[KEY, "words", "posterior", *carried])
    more = "".join(f", {c} string" for c in carried)
    return map_batches(docs.select(KEY, "text", *carried), rows, f"{KEY} long, words long, posterior array<double>{more}")
