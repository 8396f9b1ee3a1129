"""SentencePiece encoding and decoding on the tokenizers library.

The model protobuf is parsed here (its wire format, no generated classes); normaliser, white space marker, scores and
byte fallback are rebuilt as a tokenizers pipeline, and batches are encoded by the library's threads inside Spark
tasks. Both model kinds are supported: unigram by its scores, BPE by the merges that the scores imply.

White space marker: each space becomes U+2581 and, where the model says so, one is put in front. A text is one
sequence: it is not cut to words before merges or scores are applied.
"""

from __future__ import annotations

import hashlib
import os
import struct
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import documents

MARK = "▁"
# The model format's piece types and model kinds.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Bytes of text in one call of the library.
CALL = 1 << 20


@dataclass
class Model:
    pieces: list[tuple[str, float, int]]
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True

    @property
    def unk(self) -> int:
        return next(i for i, (_, _, t) in enumerate(self.pieces) if t == UNKNOWN)


def _fields(data: bytes):
    """(field number, value) of one protobuf message: int for varints, bytes for the other wire types."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(wire)
        if size is None:
            if wire != 2:
                raise ValueError(f"wire type {wire} is not part of a model file")
            size = varint()
        yield tag >> 3, data[at:at + size]
        at += size


def parse_model(data: bytes) -> Model:
    """The parts of a SentencePiece model file that encoding and decoding need."""
    m = Model([])
    for field, value in _fields(data):
        if field == 1:  # piece
            piece, score, kind = "", 0.0, NORMAL
            for f, v in _fields(value):
                if f == 1:
                    piece = v.decode()
                elif f == 2:
                    score = struct.unpack("<f", v)[0]
                elif f == 3:
                    kind = v
            m.pieces.append((piece, score, kind))
        elif field == 2:  # trainer
            for f, v in _fields(value):
                if f == 3:
                    m.kind = v
                elif f == 35:
                    m.byte_fallback = bool(v)
        elif field == 3:  # normaliser
            for f, v in _fields(value):
                if f == 2:
                    m.charsmap = v
                elif f == 3:
                    m.add_prefix = bool(v)
                elif f == 4:
                    m.remove_extra = bool(v)
                elif f == 5:
                    m.escape = bool(v)
    if m.kind not in (UNIGRAM, BPE):
        raise ValueError(f"model kind {m.kind} is neither unigram nor BPE")
    return m


def merges(model: Model) -> list[tuple[str, str]]:
    """The merges a BPE model's scores imply: every split of a piece into two pieces, better pieces first."""
    ids = {p: i for i, (p, _, t) in enumerate(model.pieces) if t in (NORMAL, USER_DEFINED)}
    out = []
    for p, i in ids.items():
        splits = [(p[:k], p[k:]) for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        out += [(-model.pieces[i][1], ids[a], ids[b], a, b) for a, b in splits]
    return [(a, b) for *_, a, b in sorted(out)]


def build(model: Model):
    """A tokenizers.Tokenizer that encodes and decodes as the model does, whole texts without a cut."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers
    if model.kind == BPE:
        core = models.BPE({p: i for i, (p, _, _) in enumerate(model.pieces)}, merges(model),
                          unk_token=model.pieces[model.unk][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk, model.byte_fallback)
    t = Tokenizer(core)
    # each marker a space; Replace would run a regex on every token. A marker that is a piece is never spelt in bytes, so
    # that it may become a space in the whole text
    mark = [decoders.Metaspace(MARK, "never")] if model.escape else []
    joined = [*([decoders.ByteFallback()] if model.byte_fallback else []), decoders.Fuse()]
    steps = joined + mark if any(p == MARK and k == NORMAL for p, _, k in model.pieces) else mark + joined
    t.decoder = decoders.Sequence(steps + ([decoders.Strip(" ", 1, 0)] if model.add_prefix else []))
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    if model.add_prefix:
        steps.append(normalizers.Prepend(MARK if model.escape else " "))
    if steps:
        t.normalizer = normalizers.Sequence(steps)
    return t


_built: dict[tuple, object] = {}


class Codec:
    """A model by its content; built once in each Python worker."""

    def __init__(self, data: bytes, threads: int | None = None):
        self.data, self.threads, self.name = data, threads, hashlib.sha256(data).hexdigest()

    def _once(self, what: str, make):
        if (self.name, what) not in _built:
            many = (self.threads or 1) > 1
            os.environ["TOKENIZERS_PARALLELISM"] = str(many).lower()  # one thread: the task's own, no pool beside it
            os.environ.setdefault("RAYON_NUM_THREADS", str(self.threads or 1))
            _built[self.name, what] = make()
        return _built[self.name, what]

    def model(self) -> Model:
        return self._once("model", lambda: parse_model(self.data))

    def tokenizer(self):
        return self._once("whole", lambda: build(self.model()))

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, without special tokens. The library's threads share the batch."""
        return [e.ids for e in self.tokenizer().encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer().decode_batch(ids, skip_special_tokens=False)

    def verified(self, texts: list[str]) -> list[tuple[np.ndarray, bool, bool]]:
        """(ids, round_trip, parity) of each text.

        Every whole text goes through the model's pipeline -- normaliser, marker, merges or unigram scores, byte
        fallback -- and its ids through the decoder; the sentencepiece library encodes the same texts. The ids are this codec's, and it is them that are decoded; where sentencepiece
        gives others ``parity`` is false. One case is known: pieces of equal score (runs of over 16 spaces) can't be
        ranked by merges.
        """
        import sentencepiece
        other = self._once("other", lambda: sentencepiece.SentencePieceProcessor(model_proto=self.data))
        ids = self.encode(texts)
        return [(np.frombuffer(array("i", i), np.int32), d == t.replace(MARK, " ") if self.model().escape else d == t, i == o) for i, d, t, o in
                zip(ids, self.decode(ids), texts, other.encode(texts, num_threads=self.threads or 1))]


def _calls(texts: list[str]):
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CALL:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_column(docs: DataFrame, codec: Codec, text: str = "text") -> DataFrame:
    """Add n_tokens, ids (array<int>), n_byte_tokens, round_trip and parity to ``docs``, row by row.

    Null or empty text: no tokens, both flags true. ``round_trip``: decoding the ids gives the text, with marker
    characters of the text itself as spaces. ``parity``: the sentencepiece library gives the same ids. Any columns may
    be there, those named as a new one are replaced; repeated rows stay as they are. Batches are encoded by as many
    threads as a task has cpus (``spark.task.cpus``), unless the codec names a number.
    """
    if codec.threads is None:
        codec = Codec(codec.data, int(docs.sparkSession.sparkContext.getConf().get("spark.task.cpus", "1")))
    new = "n_tokens long, ids array<int>, n_byte_tokens long, round_trip boolean, parity boolean"
    names = [x.split()[0] for x in new.split(", ")]
    kept = docs.drop(*names)

    def run(batches):
        is_byte = np.array([t == BYTE for _, _, t in codec.model().pieces])
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            for lo, hi in _calls(texts):
                found = codec.verified(texts[lo:hi])
                size = [len(ids) for ids, _, _ in found]
                ids = np.concatenate([ids for ids, _, _ in found])
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *size]), pa.int32()), pa.array(ids, pa.int32()))
                arrays = [pa.array(size, pa.int64()), lists,
                          pa.array([int(is_byte[i].sum()) for i, _, _ in found], pa.int64()),
                          pa.array([r for _, r, _ in found]), pa.array([p for _, _, p in found])]
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, *arrays],
                                                 names=[*batch.schema.names, *names])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{schema}, {new}")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    """The place of a public model; a parameter wherever a model is read."""
    import public_tokenizers
    return public_tokenizers.path(name)


def load_codec(path: str | None = None, threads: int | None = None) -> Codec:
    """The model file is some hundred KB; it goes to the tasks with the function that uses it."""
    with open(path or model_path(), "rb") as f:
        return Codec(f.read(), threads)


def op6_sentencepiece(spark, sf_dir):
    """Every whole text of ``documents`` encoded, decoded and compared with the sentencepiece library, row by row."""
    d = encode_column(documents(spark, sf_dir).select("doc_id", "text"), load_codec())
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))  # compiled, unlike a lambda over the array
    return d.select("doc_id", "n_tokens", "n_byte_tokens", F.sha2(ids, 256).alias("ids_sha256"), "round_trip", "parity")
