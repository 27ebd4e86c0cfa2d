"""Token ids on disk as compressed bit planes.

Ids are cut into blocks of a fixed number. A block is a matrix of one row per
id and one column per bit; it is transposed, so that each bit's plane is one
run of bytes, and every plane is compressed by zstandard by itself. Planes of
zeros take no bytes. A block is self-describing::

    b"BPL1" | ids: u32 | planes: u8 | compressed size of each plane: u32 ... | planes

The store is a folder of Parquet files whose rows are blocks (``kind`` 0) and
documents (``kind`` 1), so it can be on any file system that Spark writes to.
The rows of one shard hold its chunk index: place, id count, bytes and checksum
of each block, and first id and id count of each document. Shards follow each
other in document order, and so do ids in a shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_keys, short_batches
from .tokens import encoder

MAGIC = b"BPL1"
BLOCK_IDS = 1 << 16
STORED = ("shard int, kind int, place long, first long, n long, doc_id long, payload binary, "
          "payload_bytes long, payload_crc32 long")
READ = "shard int, doc_id long, first long, n_tokens long, ids_crc32 long, ids binary"


def encode_block(ids: np.ndarray, level: int = 3) -> bytes:
    """A block of unsigned 32-bit ids as compressed bit planes."""
    import zstandard

    n_planes = int(ids.max()).bit_length() if len(ids) else 0
    packer = zstandard.ZstdCompressor(level=level, write_checksum=False)
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    planes = np.packbits(np.ascontiguousarray(bits[:, :n_planes].T), axis=1, bitorder="little")
    packed = [packer.compress(p.tobytes()) if p.any() else b"" for p in planes]
    return b"".join([MAGIC, struct.pack(f"<IB{n_planes}I", len(ids), n_planes, *map(len, packed)), *packed])


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block."""
    import zstandard

    if block[:4] != MAGIC:
        raise ValueError("no bit-plane block")
    n, n_planes = struct.unpack_from("<IB", block, 4)
    sizes = struct.unpack_from(f"<{n_planes}I", block, 9)
    at, width = 9 + 4 * n_planes, -(-n // 8)
    planes = np.zeros((32, width), np.uint8)
    reader = zstandard.ZstdDecompressor()
    for k, size in enumerate(sizes):
        if size:
            planes[k] = np.frombuffer(reader.decompress(block[at:at + size], max_output_size=width), np.uint8)
        at += size
    bits = np.unpackbits(planes, axis=1, count=n, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u4").ravel()


def write_token_ids(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 1,
                    block_ids: int = BLOCK_IDS) -> None:
    """Encode every whole text, append ``end_id``, and store the ids by ascending doc_id at ``path``.

    Null and empty texts have the end id alone. Null doc_ids come first; equal
    ones are ordered by their text's hash, repeated rows are stored each for
    itself. Only doc_id and text are read. Ranges of doc_ids become shards.
    """
    short_batches(docs.sparkSession)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), row_keys(doc_id, F.col("text"))[1], F.col("text").alias("text"))
    ordered = rows.repartitionByRange(partitions, "doc_id", "k2").sortWithinPartitions("doc_id", "k2")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard = encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        waiting, held, written, total = [], 0, 0, 0

        def block_row(ids: np.ndarray, place: int):
            payload = encode_block(ids)
            return (shard, 0, place, place * block_ids, len(ids), None, payload, len(payload), zlib.crc32(payload))

        def batch_of(out):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), KINDS)], names=[c.split()[0] for c in STORED.split(", ")])

        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = enc.ids([text.as_py() or ""])[0] + end
                n = len(ids) // 4
                out.append((shard, 1, None, total, n, doc, None, None, None))
                total += n
                waiting.append(ids)
                held += n
                if held >= block_ids:
                    whole = np.frombuffer(b"".join(waiting), "<u4")
                    for at in range(0, held - held % block_ids, block_ids):
                        out.append(block_row(whole[at:at + block_ids], written))
                        written += 1
                    held %= block_ids
                    waiting = [whole[len(whole) - held:].tobytes()]
            if out:
                yield batch_of(out)
        if held:
            yield batch_of([block_row(np.frombuffer(b"".join(waiting), "<u4"), written)])

    ordered.mapInArrow(store, STORED).write.parquet(path)


KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]


def read_token_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of a store: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, ids.

    ids: little-endian unsigned 32-bit, null unless ``with_ids``. Raises on a
    block that is damaged or missing. A shard's rows are streamed through one
    task, blocks before the documents that end in them.
    """
    stored = spark.read.schema(STORED).parquet(path)
    # one row per shard, that is per write task
    ends = (stored.filter("kind = 1").groupBy("shard").agg(F.sum("n").alias("n")).orderBy("shard").collect())
    starts, total = {}, 0
    for r in ends:
        starts[r.shard] = total
        total += r.n
    until = F.when(F.col("kind") == 1, F.col("first") + F.col("n")).otherwise(F.col("first")).alias("until")
    rows = (stored.select("shard", "kind", "first", "n", "doc_id", "payload", "payload_crc32", until)
            .repartition("shard").sortWithinPartitions("shard", "until", "kind"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, have = None, b"", 0  # ids from id `have - len(ids) // 4` up to `have` of the shard
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["shard"] != shard:
                    shard, ids, have = r["shard"], b"", 0
                if r["kind"] == 0:
                    if r["first"] != have or zlib.crc32(r["payload"]) != r["payload_crc32"]:
                        raise ValueError(f"shard {shard}: block at id {r['first']} is damaged or out of place")
                    ids += decode_block(r["payload"]).tobytes()
                    have += r["n"]
                    continue
                if r["first"] + r["n"] > have:
                    raise ValueError(f"shard {shard}: no block holds id {have}")
                low = r["first"] - (have - len(ids) // 4)
                own = ids[4 * low:4 * (low + r["n"])]
                if low > BLOCK_IDS:  # all documents before this one are done
                    ids = ids[4 * low:]
                out.append((shard, r["doc_id"], starts[shard] + r["first"], r["n"], zlib.crc32(own),
                            own if with_ids else None))
            if out:
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 names=[c.split()[0] for c in READ.split(", ")])

    found = rows.mapInArrow(decode, READ)
    return found.select("doc_id", F.col("first").alias("start"), "n_tokens", "ids_crc32", "ids")


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per block: shard, place, first (its first id in the shard), n, payload_bytes, payload_crc32."""
    stored = spark.read.schema(STORED).parquet(path)
    return stored.filter("kind = 0").select("shard", "place", "first", "n", "payload_bytes", "payload_crc32")
