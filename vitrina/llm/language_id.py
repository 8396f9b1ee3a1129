"""Language ID by string kernels: blended-spectrum presence kernel, Nystroem landmarks, one-versus-rest kernel ridge
regression, scored by batched matrix products.

A text is the set of its character n-grams, n = 1 .. 4, lower-cased, with runs of other characters than letters as one
space (n-grams are hashed to DIMS places). The kernel of two texts is the share of common n-grams, |A & B| /
sqrt(|A| |B|). Landmarks are a few training texts; their kernel matrix gives the Nystroem map, ridge regression on
mapped training texts gives one function per language. All of that is linear in the presence vector of a new text, so
it folds into one DIMS x languages matrix, and a batch is scored by one product with the batch's presence matrix.

The model is fitted on a sample of at most TRAIN_ROWS labelled rows of at most TRAIN_CHARS characters each, dealt
evenly to the languages and picked by a hash of the id; its size (DIMS x languages doubles) does not grow with the
corpus. Prediction reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import KEY, doc_id, documents, map_batches, one_row_per_document
from vitrina.llm.textbytes import mix

TRAIN_ROWS, TRAIN_CHARS = 1600, 20_000
LANDMARKS = 256
ORDERS = (1, 2, 3, 4)
DIMS = 1 << 16
RIDGE = 1e-3
#: Characters hashed at a time, and documents of one presence matrix.
CHUNK, ROWS = 1 << 19, 64
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """For every code point, whether it is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def presence(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(presence matrix, has a letter) of up to ROWS texts at a time, in order."""
    for at in range(0, len(texts), ROWS):
        part = texts[at:at + ROWS]
        flags = np.zeros((len(part), DIMS), np.float32)
        letter = np.zeros(len(part), bool)
        row = 0
        while row < len(part):  # texts of about CHUNK characters together
            end, size = row, 0
            while end < len(part) and (end == row or size + len(part[end]) <= CHUNK):
                size += len(part[end])
                end += 1
            _mark(part[row:end], flags[row:end], letter[row:end])
            row = end
        yield flags, letter


def _mark(texts: list[str], flags: np.ndarray, letter: np.ndarray) -> None:
    low = [t.lower() for t in texts]
    c = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(low)), [len(t) for t in low])
    ok = is_letter()[c]
    letter[np.unique(row[ok])] = True
    c = np.where(ok, c, 32)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32) | (row[1:] != row[:-1])
    c, row = c[keep].astype(np.uint64), row[keep]
    h = np.zeros(len(c), np.uint64)
    for n in ORDERS:
        if len(c) < n:
            return
        m = len(c) - n + 1
        h = h[:m] * np.uint64(0x100000001B3) + c[n - 1:] + np.uint64(1)
        own = row[:m] == row[n - 1:]
        flags[row[:m][own], (mix(h + np.uint64(n << 56)) >> np.uint64(48))[own].astype(np.int64)] = 1.0


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # DIMS x languages
    bias: np.ndarray

    def least_score(self, share: float) -> float:
        """The score ``share`` of the way from undecided to sure. The k scores of a text sum to 1, so 1 / k is undecided
        and no best score is lower. One language has nothing to be told from: no limit."""
        k = len(self.languages)
        return 1 / k + share * (1 - 1 / k) if k > 1 else 0.0

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of each text; UNKNOWN and 0 without a letter or without a model."""
        names, scores = [], []
        for x, letter in presence(texts):
            size = np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
            out = (x @ self.weights) / size + self.bias if self.languages else np.zeros((len(x), 0))
            for ok, row in zip(letter.tolist(), out):
                best = int(row.argmax()) if ok and len(row) else -1
                names.append(self.languages[best] if best >= 0 else UNKNOWN)
                scores.append(float(np.clip((row[best] + 1) / 2, 0, 1)) if best >= 0 else 0.0)
        return names, scores


def fit(rows: list[tuple[str, str]], landmarks: int = LANDMARKS) -> Model:
    """Kernel ridge regression on (text, language) rows, in their order; the first rows are the landmarks."""
    languages = sorted({lang for _, lang in rows})
    if not rows:
        return Model([], np.zeros((DIMS, 0), np.float32), np.zeros(0))
    texts = [t for t, _ in rows]
    kernel_rows = lambda part: (f / np.sqrt(np.maximum(f.sum(1, keepdims=True), 1)) for f, _ in presence(part))
    marks = np.empty((min(landmarks, len(texts)), DIMS), np.float32)
    for i, x in enumerate(kernel_rows(texts[:landmarks])):
        marks[i * ROWS:i * ROWS + len(x)] = x
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # landmarks x rank: K^-1/2
    mapped = np.hstack([np.concatenate([x @ marks.T for x in kernel_rows(texts)]) @ root, np.ones((len(rows), 1))])
    y = np.where(np.array([lang for _, lang in rows])[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    gram = mapped.T @ mapped + RIDGE * len(rows) * np.diag([1.0] * (mapped.shape[1] - 1) + [1e-9])
    w = np.linalg.solve(gram, mapped.T @ y)
    return Model(languages, (marks.T @ (root @ w[:-1])).astype(np.float32), w[-1])


def held_out():
    """Documents that no model learns from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def training_rows(docs: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> list[tuple[str, str]]:
    """At most ``rows`` (text, lang) pairs, as many of each language, in turn; a few MB by the two limits."""
    d = docs.where(F.col("lang").isNotNull() & (F.length("text") <= chars) & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in d.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(rows).collect()}
    if not counts:
        return []
    each = max(1, rows // len(counts))
    rank = F.xxhash64("doc_id", "text")
    part = F.pmod(rank, F.lit(1 << 20)) / (1 << 20)
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, (each + 6 * each ** 0.5 + 6) / n))])
    found: dict[str, list] = {lang: [] for lang in counts}
    picked = d.where(part < share[F.col("lang")]).select(rank.alias("rank"), "lang", "text")
    for r in picked.orderBy("rank").limit(int(rows + len(counts) * (12 * each ** 0.5 + 12))).collect():
        if len(found[r["lang"]]) < each:
            found[r["lang"]].append((r["text"], r["lang"]))
    return [own[i] for i in range(each) for own in found.values() if i < len(own)]


def predicted(docs: DataFrame, model: Model, *carried: str) -> DataFrame:
    """(_doc, carried..., lang_pred, score) of (_doc, text, carried...); ``carried`` may be any columns."""
    kept = docs.select(KEY, *[c for c in carried if c != "text"], "text")

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores = model.predict([t or "" for t in batch.column(batch.num_columns - 1).to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column(0), *[batch.column(batch.schema.get_field_index(c)) for c in carried],
                                           pa.array(names), pa.array(scores, pa.float64())],
                                          names=[KEY, *carried, "lang_pred", "score"])
    types = "".join(f", `{c}` {kept.schema[c].dataType.simpleString()}" for c in carried)
    return map_batches(kept, rows, f"{KEY} long{types}, lang_pred string, score double")


def fitted(docs: DataFrame) -> Model:
    """The model of the documents that are not held out. ``docs``: doc_id, text, lang."""
    return fit(training_rows(docs.where(~F.coalesce(held_out(), F.lit(False)))))


def op3_language_id(spark, sf_dir):
    """Predicted language of ``documents``. One row per doc_id; a null id is not held out, its row may be learned from.
    Null text, or text without a letter: und, 0; so is every text where no labelled row is there to learn from."""
    docs = documents(spark, sf_dir)
    d = predicted(one_row_per_document(docs), fitted(docs))
    return (d.select(doc_id(), "lang_pred", "score")
            .select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score"))
