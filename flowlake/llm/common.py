"""Helpers shared by the operators: table access, row keys, written tables, text buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

U64 = np.uint64


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def short_batches(spark: SparkSession) -> None:
    """Send 1000 rows at a time to Python unless the session sets a number of its own.

    Rows here hold whole texts; Spark's default of 10000 makes batches of tens
    of megabytes, of which the JVM and the worker hold several copies.
    """
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: what follows reads finished files, so a lost executor
    costs only its own tasks and no later step repeats the work above.
    """
    short_batches(df.sparkSession)
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_way_of(df: DataFrame, label: str, step, result: str) -> DataFrame:
    """``step(df)`` written, from a table of ``df``'s rows that is removed when the result is there.

    For steps that read their input twice, as a sort by ranges does.
    """
    spark = df.sparkSession
    short_batches(spark)
    path = shared_path(spark, label)
    df.write.parquet(path)
    out = written(step(spark.read.schema(df.schema).parquet(path)), result)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return out


def row_keys(doc_id: Column, text: Column) -> list[Column]:
    """128 bits that name a row by content; identical rows share them.

    Stable under recomputation (no partition or position in it) and never null.
    """
    return [F.xxhash64(doc_id, F.lit("id")).alias("k1"), F.xxhash64(text, F.lit("text")).alias("k2")]


def keyed(docs: DataFrame) -> DataFrame:
    """k1, k2, doc_id (long) and text of every row; other columns stay behind."""
    short_batches(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    return docs.select(*row_keys(doc_id, F.col("text")), doc_id.alias("doc_id"), F.col("text").alias("text"))


def internal(df: DataFrame, name: str) -> str:
    """A column name made from ``name`` that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: What encoders of this process remember; freed when other work begins.
MEMORIES: list[dict] = []


def arrow_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column end to end, and the rows' offsets in them (null: empty)."""
    for memory in MEMORIES:
        memory.clear()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, offsets


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """The batches put together to some ``rows`` rows each; empty ones are left out."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def row_groups(offsets: np.ndarray, limit: int):
    """Consecutive row ranges (lo, hi) of at most ``limit`` bytes, or one longer row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class RangeHash:
    """Hashes of many byte ranges of one buffer from one prefix sum each.

    The hash of a range is polynomial over Z/2^64 in a fixed odd base, of
    per-byte random values; equal ranges hash alike wherever they stand.
    """

    BASE = {1: 0x9E3779B97F4A7C15, 2: 0xD6E8FEB86659FD93}
    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    _values: dict[int, np.ndarray] = {}

    def __init__(self, buf: np.ndarray, seed: int = 1):
        """buf: bytes, or 64-bit hashes that stand for longer symbols."""
        n = len(buf) + 1
        if seed not in self._values:
            self._values[seed] = mix64((np.arange(256, dtype=U64) + U64(seed * 1000 + 1)) * U64(self.BASE[seed])) | U64(1)
        power, inverse = self._powers.get(seed, (np.zeros(0, U64),) * 2)
        if len(power) < n:
            size = max(n, 1 << 16)
            power, inverse = np.full(size, self.BASE[seed], U64), np.full(size, pow(self.BASE[seed], -1, 1 << 64), U64)
            power[0] = inverse[0] = 1
            power, inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
            if size <= 1 << 20:
                self._powers[seed] = power, inverse
        self.inverse = inverse
        self.sums = np.zeros(n, U64)
        values = self._values[seed][buf] if buf.dtype == np.uint8 else mix64(buf + U64(seed)) | U64(1)
        np.cumsum(values * power[:n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of buf[start:end] for each pair."""
        return mix64((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(U64))

    def sliding(self, width: int) -> np.ndarray:
        """Hash of buf[i:i + width] for every i it fits."""
        if len(self.sums) <= width:
            return np.zeros(0, U64)
        diff = self.sums[width:] - self.sums[:-width]
        return mix64(diff * self.inverse[:len(diff)] + U64(width))


#: Words longer than this are hashed by the library: from 1024 bytes on, a polynomial modulo 2^64 can be fooled.
LONG_WORD = 256


def words_of(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and 64-bit hash of each word (ASCII white space separates) of texts end to end."""
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    first = np.ones(len(buf) + 1, bool)  # a word starts where space or another document ends
    first[1:-1] = space[:-1]
    first[offsets] = True
    start = np.flatnonzero(first[:-1] & ~space)
    last = np.ones(len(buf) + 1, bool)
    last[:-1] = space
    last[offsets] = True
    stops = np.flatnonzero(last)
    end = stops[np.searchsorted(stops, start, side="right")] if len(start) else start
    word = RangeHash(buf).of(start, end)
    for i in np.flatnonzero(end - start > LONG_WORD):
        word[i] = xxhash.xxh64_intdigest(buf[start[i]:end[i]].tobytes())
    return start, word
