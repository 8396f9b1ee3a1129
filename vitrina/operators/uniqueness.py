"""Q-4 against history: is a key of this load in an earlier one?

For every load the catalog keeps its distinct keys, in files sorted by key,
and a Bloom filter of them: blocks of 512 bits, about 16 to 32 bits a key, a
row a block. A load is held against the loads whose files its key ranges meet:
its keys probe the blocks of their filters (equi-joins, built-in functions),
and only for keys that a filter holds are that load's files read, as far as
their ranges meet such keys. A filter tells a key that it has not seen for
seen about once in some hundred times; the exact check settles these.

Where keys grow with time, ranges alone leave few loads. Where they don't, a
load's keys probe each earlier filter once: a few bytes a key are read there in
place of the keys, and work grows with the number of loads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.operators.catalog import _BUCKET, FILE_ROWS, Transaction
from vitrina.operators.merge import _keys
from vitrina.session import cut_lineage

#: Longs of a block, bits that a key sets in it, and keys that a block is meant for.
WORDS, BITS, PER_BLOCK = 8, 4, 32
_FILTER = T.StructType([T.StructField("load", T.StringType()), T.StructField("block", T.LongType()),
                        *[T.StructField(f"w{k}", T.LongType()) for k in range(WORDS)]])


def _block(keys: list[str], blocks) -> Column:
    return F.pmod(F.xxhash64(*keys), blocks)


def _places(keys: list[str]) -> list[Column]:
    """Places, in a block, of the bits of a key: 9 bits of a second hash each."""
    h = F.xxhash64(F.lit(1), *keys)
    return [F.shiftright(h, 9 * k).bitwiseAND(F.lit(64 * WORDS - 1)).cast("int") for k in range(BITS)]


def _filter(distinct: DataFrame, keys: list[str], load: str, blocks: int) -> DataFrame:
    """The filter of a load, a row for each block that has a key."""
    p = distinct.select(_block(keys, F.lit(blocks)).alias("block"), F.explode(F.array(*_places(keys))).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)))
    words = [F.coalesce(F.bit_or(F.when(F.shiftright("place", 6) == k, bit)), F.lit(0).cast("long")).alias(f"w{k}") for k in range(WORDS)]
    return p.groupBy("block").agg(*words).select(F.lit(load).alias("load"), "block", *[f"w{k}" for k in range(WORDS)])


def _holds(keys: list[str]) -> Column:
    """Has the filter's block, in the same row, all bits of the key?"""
    words = F.array(*[f"w{k}" for k in range(WORDS)])
    has = [F.call_function("getbit", F.get(words, F.shiftright(p, 6)), p.bitwiseAND(F.lit(63))) == 1 for p in _places(keys)]
    return reduce(lambda a, b: a & b, has)


def _files_of(tx: Transaction, name: str, loads: list[str]) -> list[str]:
    numbers = [tx.entry(name)["loads"][x][0] for x in loads]
    return [r[0] for r in tx.index(name).where(F.col("bucket").isin(numbers)).select("file").collect()] if numbers else []


def check_load(tx: Transaction, load: str, rows: DataFrame, keys, name: str = "unique_keys") -> tuple[DataFrame, dict]:
    """Q-4 of a load (its id: the load date, say) against itself and all earlier loads; the load is kept as one of them.

    Returns the keys that clash -- (keys, occurrences in this load, earlier_loads that hold the key, first_load of them
    by id) -- and how many loads there were, had their filters and their keys read. Rows with a null in a key clash with
    nothing. A load that is run again is not held against its earlier run, which it replaces.
    """
    keys = _keys(keys)
    entry, filters = tx.entry(name), f"{name}_filters"
    loads = dict(entry["loads"]) if entry else {}
    number = loads.pop(load, [max((x[0] for x in loads.values()), default=-1) + 1])[0]
    schema = T.StructType.fromJson(entry["schema"]) if entry else T.StructType([rows.schema[k] for k in keys]).add("load", T.StringType())
    typed = rows.select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in keys]).dropna()
    own = cut_lineage(typed.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")))
    n = own.count()

    by_number = {x[0]: (known, x[1]) for known, x in loads.items()}
    index = tx.index(name).where(F.col("bucket") != number) if entry else None
    near = tx.meeting(index, own, keys).select("bucket").distinct().collect() if loads else []
    near = sorted(r[0] for r in near)
    hit_loads = []
    found = tx._rows([], schema)
    if near:
        to = F.array(*[F.struct(F.lit(by_number[x][0]).alias("load"), F.lit(by_number[x][1]).cast("long").alias("blocks")) for x in near])
        probe = own.select(*keys, F.explode(to).alias("to")).select(*keys, "to.load", _block(keys, F.col("to.blocks")).alias("block"))
        f = tx._rows(_files_of(tx, filters, [by_number[x][0] for x in near]), _FILTER)
        hits = cut_lineage(probe.join(f, ["load", "block"]).where(_holds(keys)).select(*keys, "load"))
        hit_loads = sorted(r[0] for r in hits.select("load").distinct().collect())
        if hit_loads:
            of = tx.meeting(index.where(F.col("bucket").isin([loads[x][0] for x in hit_loads])), hits, keys)
            found = tx._rows([r[0] for r in of.select("file").collect()], schema).join(hits, [*keys, "load"], "left_semi")
    found = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("earlier_loads"), F.min("load").alias("first_load"))
    clashes = cut_lineage(own.join(found, keys, "left").where("occurrences > 1 or earlier_loads is not null")
                          .select(*keys, "occurrences", F.coalesce("earlier_loads", F.lit(0)).cast("long").alias("earlier_loads"), "first_load"))

    blocks = 1 << max(0, -(-n // PER_BLOCK) - 1).bit_length()
    kept = loads | {load: [number, blocks]}
    sides = ((name, own.select(*keys, F.lit(load).alias("load")), schema, keys), (filters, _filter(own, keys, load, blocks), _FILTER, ["block"]))
    for table, df, of, by in sides:
        df = df.withColumn(_BUCKET, F.lit(number)).repartitionByRange(max(1, -(-n // FILE_ROWS)), *by).sortWithinPartitions(*by)
        new = tx._write(df, table, by, [_BUCKET])[1]
        if tx.entry(table) is not None:
            new = tx.index(table).where(F.col("bucket") != number).unionByName(new)
        tx.stage(table, new, of, by, loads=kept)
    return clashes, {"loads": len(loads), "filters_read": len(near), "keys_read": len(hit_loads)}
