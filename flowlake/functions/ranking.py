"""Position of each row inside its key, without gathering a key into one task.

``row_number() over (partition by k order by o)`` sends every row of a key to
one task; one key holding a third of the table then runs as one task.  Here the
rows are range-partitioned on ``(k, o)`` instead, so a hot key is cut across
many partitions, and the position is finished in two narrow passes:

1. range-partition + sort, then checkpoint to the shared checkpoint folder (the
   range bounds are sampled, so the layout must be fixed before it is read
   twice);
2. pass A: each partition reports its first and last key and their run lengths
   (one row per partition);
3. on the driver, the per-partition rows (bounded by the partition count) give
   the rows of a key that precede each partition;
4. pass B: each partition numbers its rows with a vectorised cumulative count,
   starting its first key at that carry. Rows stay Arrow batches throughout, so
   no value is converted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import ensure_checkpoint_dir

#: Column of ``sorted_checkpoint``: the number of the row's partition. It is stored with the
#: rows, because a task's own number is another one once the result is part of a union.
PART = "_part"


def part_of(batch: pa.RecordBatch) -> int:
    """Number of the partition that a batch (not empty) comes from."""
    return batch.column(PART)[0].as_py()


def _row_key(batch: pa.RecordBatch, by, i: int) -> tuple:
    return tuple(batch.column(c)[i].as_py() for c in by)


def _key_eq(x, y) -> bool:
    """Equality of two keys as Spark groups them: null equals null, NaN equals NaN."""
    if x is None or y is None:
        return x is y
    return all(u == v or (u != u and v != v) for u, v in zip(x, y))


def _changes(batch: pa.RecordBatch, by, prev_key) -> np.ndarray:
    """Whether each row's key differs from the row's before (the first row's: from ``prev_key``).

    Compares Arrow columns, so large integers are never rounded through floats.
    """
    n = batch.num_rows
    change = np.zeros(n, bool)
    for c in by:
        col = batch.column(c)
        above, below = col.slice(0, n - 1), col.slice(1)
        differs = pc.fill_null(pc.not_equal(below, above), False).to_numpy(zero_copy_only=False)
        if pa.types.is_floating(col.type):
            nan = pc.fill_null(pc.is_nan(col), False).to_numpy(zero_copy_only=False)
            differs = differs & ~(nan[1:] & nan[:-1])
        null = pc.is_null(col).to_numpy(zero_copy_only=False)
        change[1:] |= differs | (null[1:] != null[:-1])
    if n:
        change[0] = not _key_eq(_row_key(batch, by, 0), prev_key)
    return change


def sorted_checkpoint(df: DataFrame, keys, num_partitions: int | None = None) -> DataFrame:
    """Range-partition and sort on ``keys``; materialise in the checkpoint folder.

    Without ``num_partitions`` the range shuffle starts from
    ``spark.sql.shuffle.partitions`` and AQE merges adjacent small partitions
    (merging neighbours keeps the global order), so the layout follows the data
    size.  A column ``PART`` numbers the partitions.
    """
    ensure_checkpoint_dir(df.sparkSession)
    parts = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    return parts.sortWithinPartitions(*keys).withColumn(PART, F.spark_partition_id()).checkpoint(eager=True)


def partition_runs(ck: DataFrame, by) -> list:
    """Pass A: per partition (pid, rows, first key, its run, last key, its run)."""
    key_fields = [ck.schema[c] for c in by]
    schema = T.StructType(
        [T.StructField("pid", T.IntegerType()), T.StructField("n", T.LongType()),
         T.StructField("first_run", T.LongType()), T.StructField("last_run", T.LongType())]
        + [T.StructField(f"f_{f.name}", f.dataType) for f in key_fields]
        + [T.StructField(f"l_{f.name}", f.dataType) for f in key_fields])

    def summarize(batches):
        pid, n = None, 0
        first = last = None
        first_run = last_run = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = np.flatnonzero(_changes(batch, by, last))
            if first is None:
                pid = part_of(batch)
                first = _row_key(batch, by, 0)
                starts = starts[1:]  # the first key's own start
                first_open = True
            if first_open:
                first_run += int(starts[0]) if len(starts) else batch.num_rows
                first_open = not len(starts)
            last_run = batch.num_rows - int(starts[-1]) if len(starts) else last_run + batch.num_rows
            last = _row_key(batch, by, batch.num_rows - 1)
            n += batch.num_rows
        if n:
            row = {"pid": pid, "n": n, "first_run": first_run, "last_run": last_run}
            row |= {f"f_{c}": v for c, v in zip(by, first)} | {f"l_{c}": v for c, v in zip(by, last)}
            yield pa.RecordBatch.from_pylist([row], schema=to_arrow_schema(schema))

    rows = ck.select(*by, PART).mapInArrow(summarize, schema).collect()
    return sorted(rows, key=lambda r: r["pid"])


def carries(runs, by) -> dict:
    """Rows of each partition's first key that lie in earlier partitions."""
    out = {}
    prev_last, prev_total = None, 0
    for r in runs:
        first = tuple(r[f"f_{c}"] for c in by)
        last = tuple(r[f"l_{c}"] for c in by)
        carry = prev_total if prev_last is not None and _key_eq(first, prev_last) else 0
        out[r["pid"]] = (first, carry)
        prev_total = carry + r["n"] if _key_eq(first, last) else r["last_run"]
        prev_last = last
    return out


def position_within(df: DataFrame, by, order, name: str = "position",
                    num_partitions: int | None = None) -> DataFrame:
    """``df`` plus a 1-based ``name`` column: the row's rank in its ``by`` key by ``order``.

    Equal to ``row_number() over (partition by by order by order)`` when the
    ordering is unique within a key.
    """
    by, order = list(by), list(order)
    ck = sorted_checkpoint(df, by + order, num_partitions)
    info = carries(partition_runs(ck, by), by)
    fields = [f for f in ck.schema if f.name != PART]
    schema = T.StructType(fields + [T.StructField(name, T.LongType(), False)])

    def assign(batches):
        begun, prev_key, prev_count = False, None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if not begun:
                begun, (prev_key, prev_count) = True, info.get(part_of(batch), (None, 0))
            change = _changes(batch, by, prev_key)
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(change, at, -1))
            position = np.where(start < 0, prev_count + at + 1, at - start + 1)
            prev_key, prev_count = _row_key(batch, by, n - 1), int(position[-1])
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), pa.array(position, pa.int64())],
                                             names=schema.names)

    return ck.mapInArrow(assign, schema)
