"""CSV files read by many tasks although quoted cells hold line breaks (S-6).

A line break ends a record only outside quotes, and whether a place of a file
is inside quotes depends on all that precedes it. But whatever a line holds,
its effect is one of four functions on {outside, inside}, and these compose.
So each split of a file is read once to find its function (one small row), a
window over the splits of each file composes them to the state in which every
split begins, and a second pass cuts the splits to records. A record that
crosses splits is put together from the pieces at their edges, at most two a
split. Nothing is sorted or shuffled but these pieces.

Lines are told by newline (a carriage return before it belongs to it), text is
UTF-8, a quote inside a quoted cell is doubled. A quote opens a cell only as its
first character, so stray quotes elsewhere change nothing. A quote that is never
closed makes the rest of its file one record, as it does for any CSV reader.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrina.session import cut_lineage, ship_package

RECORD, HEAD, TAIL = 0, 1, 2


def line_effect(sep: str, quote: str) -> Callable[[str, bool], bool]:
    """Whether a line ends inside quotes, by its text and whether it begins inside."""
    s, q = re.escape(sep), re.escape(quote)
    cell = rf"(?:{q}(?:[^{q}]++|{q}{q})*+{q}[^{s}]*+|(?!{q})[^{s}]*+)"
    opens = re.compile(rf"(?:{cell}{s})*+{q}(?:[^{q}]++|{q}{q})*+\Z", re.S)
    rest = re.compile(rf"(?:[^{q}]++|{q}{q})*+", re.S)

    def effect(line: str, inside: bool) -> bool:
        at = 0
        if inside:
            close = rest.match(line).end()
            if close == len(line):
                return True
            at = line.find(sep, close + 1) + 1
            if not at:
                return False
        return opens.match(line[at:]) is not None
    return effect


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """((file, block), lines) of rows in a row with the same split."""
    for b in batches:
        if not b.num_rows:
            continue
        file, block = b.column(0).dictionary_encode(), b.column(1).to_numpy()
        code = file.indices.to_numpy()
        edges = np.flatnonzero((np.diff(code) != 0) | (np.diff(block) != 0)) + 1
        for lo, hi in zip([0, *edges], [*edges, b.num_rows]):
            yield (file.dictionary[int(code[lo])].as_py(), int(block[lo])), b.column(2).slice(lo, hi - lo)


def _quoted(lines: pa.Array, quote: str) -> np.ndarray:
    return np.flatnonzero(pc.match_substring(lines, quote).to_numpy(zero_copy_only=False))


def _effects(sep: str, quote: str):
    """(file, block, from_out, from_in): the state after a split that begins outside, or inside, quotes."""
    def run(batches):
        effect, key, state, done = line_effect(sep, quote), None, [0, 1], []
        for found, lines in _runs(batches):
            if found != key:
                done += [(*key, *state)] if key else []
                key, state = found, [0, 1]
            for i in _quoted(lines, quote):
                line = lines[int(i)].as_py()
                state = [int(effect(line, bool(x))) for x in state] if state[0] != state[1] else [int(effect(line, bool(state[0])))] * 2
        done += [(*key, *state)] if key else []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["file", "block", "from_out", "from_in"])
    return run


def _cut(states: dict[str, dict[int, tuple[int, bool]]], sep: str, quote: str, pieces: bool):
    """(file, block, kind, first, record): whole records, or only the ``pieces`` of those that cross splits."""
    def run(batches):
        effect, key, inside, last = line_effect(sep, quote), None, False, False
        pending: list[str] = []
        own = first = False  # whether ``pending`` began in this split; whether the file's first record is still to come
        out: list[tuple] = []

        def emit(kind: int, record: str) -> None:
            nonlocal first
            if (kind == RECORD) != pieces and record.rstrip("\r"):
                out.append((*key, kind, first and kind != HEAD, record))
            if kind != HEAD and record.rstrip("\r"):
                first = False

        def end_split() -> None:
            if pending:
                emit(HEAD if not own else RECORD if last else TAIL, "\n".join(pending))
                pending.clear()

        def batch() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                              names=["file", "block", "kind", "first", "record"])
            out.clear()
            return made

        for found, lines in _runs(batches):
            if found != key:
                if key:
                    end_split()
                key = found
                if key[1] not in states.get(key[0], {}):
                    raise RuntimeError(f"{key[0]} was split otherwise in the first pass; fix spark.sql.files.minPartitionNum")
                inside, last = states[key[0]][key[1]]
                own, first = False, key[1] == 0
            text, done = lines.to_pylist(), 0
            for i in _quoted(lines, quote).tolist():
                after = effect(text[i], bool(inside))
                if inside and not after:  # the record that was open ends here
                    emit(RECORD if own else HEAD, "\n".join(pending + text[done:i + 1]))
                    pending.clear()
                    done = i + 1
                elif after and not inside:  # lines before this one are records, this one begins a longer one
                    for line in text[done:i]:
                        emit(RECORD, line)
                    done, own = i, True
                inside = after
            if inside:
                pending += text[done:]
            else:
                for line in text[done:]:
                    emit(RECORD, line)
            if out:
                yield batch()
        if key:
            end_split()
        if out:
            yield batch()
    return run


def csv_records(spark: SparkSession, path: str, sep: str = ",", quote: str = '"') -> DataFrame:
    """(first, record): every record of the files at ``path`` as text, blank lines left out; ``first`` marks the first
    record of each file (its header, where there is one)."""
    ship_package(spark)
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"))
    effects = cut_lineage(lines.mapInArrow(_effects(sep, quote), "file string, block long, from_out long, from_in long"))
    by_file = Window.partitionBy("file").orderBy("block")
    flip = F.when((F.col("from_out") == 1) & (F.col("from_in") == 0), 1).otherwise(0)
    e = (effects.withColumn("flips", F.sum(flip).over(by_file))
         .withColumn("fixed", F.when(F.col("from_out") == F.col("from_in"), F.struct("from_out", "flips"))))
    known = F.last("fixed", ignorenulls=True).over(by_file.rowsBetween(Window.unboundedPreceding, -1))
    e = e.select("file", "block", known.alias("k"), (F.col("flips") - flip).alias("before"), F.lead("block").over(by_file).isNull().alias("last"))
    begin = F.pmod(F.coalesce(F.col("k.from_out"), F.lit(0)) + F.col("before") - F.coalesce(F.col("k.flips"), F.lit(0)), F.lit(2))
    states: dict[str, dict[int, tuple[int, bool]]] = {}
    for r in e.select("file", "block", begin.alias("begin"), "last").collect():  # one row a split
        states.setdefault(r["file"], {})[r["block"]] = (int(r["begin"]), r["last"])
    schema = "file string, block long, kind int, first boolean, record string"
    whole = lines.mapInArrow(_cut(states, sep, quote, False), schema).select("first", "record")
    crossed = [f for f, splits in states.items() if any(b for b, _ in splits.values())]
    if crossed:
        parts = lines.where(F.col("file").isin(crossed)).mapInArrow(_cut(states, sep, quote, True), schema)
        order = Window.partitionBy("file").orderBy("block", "kind")
        parts = parts.withColumn("n", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(order))
        joined = parts.groupBy("file", "n").agg(F.max("first").alias("first"), F.sort_array(
            F.collect_list(F.struct("block", "kind", "record"))).alias("p"))
        whole = whole.unionByName(joined.select("first", F.array_join("p.record", "\n").alias("record")))
    return whole.select("first", F.regexp_replace("record", r"\r\z", "").alias("record"))
