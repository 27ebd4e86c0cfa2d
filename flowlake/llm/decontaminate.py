"""Benchmark decontamination by size-partitioned MinHash containment search.

Which long documents contain at least a given share of a short test item's
word shingles? Similarity of whole signatures is hopeless there, as the sizes
differ a thousandfold. So the items are partitioned by set size, and each
partition has a MinHash sketch as long as its largest size needs: an item's
sketch is its ``k`` smallest shingle hashes with k = size - ceil(share * size) + 1.
A document that lacks all of them lacks too many shingles, so every document
that contains the item shares a sketch value with it: no true match is missed.
Documents, split in the same size partitions, are probed with their whole
shingle sets, and only against items that they are large enough to contain.
Candidates are verified by exact containment of the shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_bytes, internal, keyed, row_groups, row_keys, written
from .lsh_forest import shingle_rows

ITEMS = "i1 long, i2 long, item_id long, size int, partition int, need int, shingles array<long>, sketch array<long>"
PROBES = "k1 long, k2 long, doc_id long, size int, hits array<long>, shingles array<long>"


def sketched_items(benchmark: DataFrame, words: int, percent: int) -> DataFrame:
    """Shingle set, size partition and sketch of every distinct item that has a word."""
    item_id = F.col("item_id").cast("long")
    rows = benchmark.select(*[c.alias(n) for c, n in zip(row_keys(item_id, F.col("text")), ("i1", "i2"))],
                            item_id.alias("item_id"), F.col("text").alias("text")).dropDuplicates(["i1", "i2"])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            out = []
            for row, s in enumerate(shingle_rows(buf[offsets[0]:offsets[-1]], offsets - offsets[0], words)):
                size = len(s)
                if not size:
                    continue
                partition = size.bit_length() - 1
                largest = (1 << partition + 1) - 1
                length = min(size, largest - -(-largest * percent // 100) + 1)
                s = s.view(np.int64)
                out.append((*(batch.column(c)[row].as_py() for c in ("i1", "i2", "item_id")), size, partition,
                            -(-size * percent // 100), s.tolist(), s[:length].tolist()))
            cols = list(zip(*out)) or [[]] * 8
            kinds = [pa.int64()] * 3 + [pa.int32()] * 3 + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=[c.split()[0] for c in ITEMS.split(", ")])

    return rows.mapInArrow(sketch, ITEMS)


def _values(items: DataFrame, column: str, bound: int) -> np.ndarray | None:
    """The distinct values of an array column in order, if they are at most ``bound``."""
    values = items.select(F.explode(column).alias("h")).distinct().limit(bound + 1)
    got = np.array([r.h for r in values.collect()], np.int64)
    return np.sort(got) if len(got) <= bound else None


def contained_items(docs: DataFrame, benchmark: DataFrame, words: int = 5, percent: int = 80,
                    bound: int = 2_000_000) -> DataFrame:
    """(k1, k2, doc_id, item_id, item_shingles, common_shingles) for every document and item it contains.

    A document contains an item when it has at least ``percent`` / 100 of the
    item's distinct ``words``-word shingles (ASCII lower case; a text with
    fewer words is one shingle). Texts that are null or have no word contain
    nothing and are contained nowhere. Fully repeated documents and items
    count once. Columns other than doc_id, item_id and text are not read.

    Up to ``bound`` distinct item shingles are sent to the tasks, which then
    return only matching ones; beyond it all document shingles are joined.
    """
    items = written(sketched_items(benchmark, words, percent), "items")
    universe = _values(items, "shingles", bound)
    sketches = _values(items, "sketch", bound) if universe is not None else None
    sc = docs.sparkSession.sparkContext
    known = sc.broadcast((universe, sketches))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        universe, sketches = known.value

        def among(values, sorted_):
            at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
            return values[sorted_[at] == values]

        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            rows, sizes, hits, shingles = [], [], [], []
            row = 0
            for lo, hi in row_groups(offsets, 1 << 20):
                for s in shingle_rows(buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], words):
                    own = s.view(np.int64)
                    hit = own
                    if universe is not None:
                        own = among(own, universe) if len(universe) else own[:0]
                        hit = among(own, sketches) if len(own) else own
                    if len(hit):
                        rows.append(row), sizes.append(len(s)), hits.append(hit), shingles.append(own)
                    row += 1
            at = pa.array(rows, pa.int64())
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(at) for c in ("k1", "k2", "doc_id")]
                + [pa.array(sizes, pa.int32()), pa.array(hits, lists), pa.array(shingles, lists)],
                names=["k1", "k2", "doc_id", "size", "hits", "shingles"])

    probes = keyed(docs).mapInArrow(probe, PROBES)
    sketch = items.select(F.col("i1"), F.col("i2"), "need", F.explode("sketch").alias("hit"))
    large_enough = F.col("size") >= F.col("need")
    candidates = (probes.withColumn("hit", F.explode("hits")).drop("hits").join(sketch, "hit").filter(large_enough)
                  .dropDuplicates(["k1", "k2", "i1", "i2"]).select("k1", "k2", "doc_id", "i1", "i2", "shingles"))
    whole = items.select("i1", "i2", "item_id", F.col("size").alias("item_shingles"), "need",
                         F.col("shingles").alias("of_item"))
    common = F.size(F.array_intersect("shingles", "of_item"))
    return (candidates.join(whole, ["i1", "i2"]).withColumn("common_shingles", common)
            .filter("common_shingles >= need")
            .select("k1", "k2", "doc_id", "item_id", F.col("item_shingles").cast("long").alias("item_shingles"),
                    F.col("common_shingles").cast("long").alias("common_shingles")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with all its columns, without the rows that contain a benchmark item."""
    key = {c: internal(docs, c) for c in ("k1", "k2")}
    found = contained_items(docs, benchmark, words, percent).select("k1", "k2").distinct()
    found = written(found, "contaminated").withColumnsRenamed(key)
    k1, k2 = row_keys(F.col("doc_id").cast("long"), F.col("text"))
    clean = docs.withColumns({key["k1"]: k1, key["k2"]: k2}).join(found, list(key.values()), "left_anti")
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])
