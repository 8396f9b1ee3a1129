"""Dense surrogate keys and running row numbers (K-8, W-3) without one big
partition.

A global ``row_number()`` window moves every row into a single task. Here the
frame is range-partitioned and sorted on the order columns (a hot value of one
column is split by the next columns), each row gets its position inside its
partition, and the per-partition counts -- one row per partition, so their size
is bounded by the partition count, never by the data -- become offsets that are
broadcast back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrina.session import cut_lineage

_PID, _MID = "_pid", "_mid"


def dense_index(df: DataFrame, order_cols: list[str], name: str = "row_index", start: int | F.Column = 1,
                stable: bool = True) -> DataFrame:
    """Add ``name`` = start, start+1, ... in the order of ``order_cols``; rows
    equal on them are ordered by a hash of their other columns.

    ``stable`` checkpoints the sorted frame into the shared checkpoint folder so
    the positions and the counts come from the same materialised rows (and the
    lineage is cut: a lost executor does not re-sort).
    """
    s = (df.orderBy(*order_cols, *tie_break(df, order_cols))
         .withColumn(_PID, F.spark_partition_id())
         .withColumn(_MID, F.monotonically_increasing_id()))
    if stable:
        s = cut_lineage(s)
    # monotonically_increasing_id = partition id << 33 | position in partition
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    counts = s.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        _PID, (F.sum("_n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    first = F.lit(start) if not isinstance(start, F.Column) else start
    out = (s.join(F.broadcast(offsets), _PID)
           .withColumn(name, (first + F.coalesce(F.col("_off"), F.lit(0)) + local).cast("long")))
    return out.select(*df.columns, name)


def tie_break(df: DataFrame, order_cols: list[str]) -> list[F.Column]:
    """Small deterministic tie-breakers: two hashes of the columns outside the
    order. Appending the columns themselves would put whole texts into the
    sort keys that range partitioning samples to the driver."""
    rest = [F.col(c) for c in df.columns if c not in order_cols]
    if not rest:
        return []
    return [F.xxhash64(*rest), F.hash(*rest)]


def max_key(df: DataFrame, key: str) -> int:
    """Largest existing key (0 for an empty table) -- one scalar to the driver."""
    v = df.agg(F.max(key)).first()[0]
    return int(v) if v is not None else 0
