"""Packing of tokenized documents into fixed windows by minimum bin slack.

Documents are cut into whole windows and one remainder. What is packed are the
remainders, and of these only the number of each length matters: at most
``capacity - 1`` counts, however large the corpus. For each window a bitset
subset-sum dynamic program over the remaining lengths finds the multiset that
fills it closest to capacity, always with the longest length left in it;
backtracking gives its counts, and the same choice is repeated as often as the
counts allow. So the plan has a few thousand patterns at most. Every remainder
finds its place from its rank among the remainders of its length.

Where the program leaves slack, the rest is laid end to end and cut at window
borders instead of padded; the last, partial window is cut at powers of two.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed, written
from .tokens import encoder

CAPACITY = 2048
END_ID = 1
SIZED = "k1 long, k2 long, doc_id long, n long, part int, full_rank long, rest int, rest_rank long, crcs binary"
PIECES = ("k1 long, k2 long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def fullest_multiset(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Counts of the lengths that fill ``capacity`` closest from below, the longest length among them.

    Bitset dynamic program: bit s of ``reach`` says that sum s can be made.
    Counts are split into powers of two, longest lengths first; a copy of the
    bitset before each part is what backtracking follows.
    """
    longest = max(counts)
    room = capacity - longest
    mask = (1 << (room + 1)) - 1
    reach, parts = 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == longest), room // length)
        share = 1
        while left > 0:
            take = min(share, left)
            parts.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            share *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen = Counter({longest: 1})
    for length, take, before in reversed(parts):
        if not before >> total & 1:
            chosen[length] += take
            total -= length * take
    return dict(chosen)


@dataclass
class Plan:
    """Where the r-th remainder of each length goes.

    places[length]: (first rank, pieces a window, first window, offset) in rank order.
    laid[length]: (first rank, position of it) of the remainders laid end to end.
    """

    capacity: int
    places: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)
    laid: dict[int, tuple[int, int]] = field(default_factory=dict)
    windows: int = 0
    laid_tokens: int = 0

    def cuts(self, position: int, length: int) -> list[tuple[int, int, int]]:
        """(length, window, offset) of the parts of a stretch of what is laid end to end."""
        whole = self.laid_tokens // self.capacity
        tail, borders = self.laid_tokens % self.capacity, []
        at = whole * self.capacity
        for bit in range(tail.bit_length() - 1, -1, -1):
            if tail >> bit & 1:
                borders.append(at)
                at += 1 << bit
        out, end = [], position + length
        while position < end:
            if position < whole * self.capacity:
                window = position // self.capacity
                first, stop = window * self.capacity, (window + 1) * self.capacity
            else:
                k = bisect.bisect_right(borders, position) - 1
                window, first = whole + k, borders[k]
                stop = borders[k + 1] if k + 1 < len(borders) else self.laid_tokens
            part = min(end, stop) - position
            out.append((part, self.windows + window, position - first))
            position += part
        return out

    @property
    def first_full(self) -> int:
        """First window of the cut-off whole windows, after all others."""
        return self.windows + self.laid_tokens // self.capacity + bin(self.laid_tokens % self.capacity).count("1")


def minimum_slack_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Plan for the number of remainders of each length (1 <= length < capacity)."""
    left = {length: n for length, n in histogram.items() if n}
    used: Counter = Counter()
    plan = Plan(capacity)
    while left:
        pattern = fullest_multiset(left, capacity)
        if sum(length * n for length, n in pattern.items()) < capacity:
            # no multiset with the longest length fills a window: that length is laid out and cut
            longest = max(pattern)
            plan.laid[longest] = (used[longest], plan.laid_tokens)
            plan.laid_tokens += longest * left.pop(longest)
            continue
        times = min(left[length] // n for length, n in pattern.items())
        offset = 0
        for length, n in pattern.items():
            plan.places.setdefault(length, []).append((used[length], n, plan.windows, offset))
            offset += length * n
            used[length] += n * times
            left[length] -= n * times
            if not left[length]:
                del left[length]
        plan.windows += times
    return plan


def sized_documents(docs: DataFrame, tokenizer: str, capacity: int, end_id: int,
                    remembered: int | None = None) -> DataFrame:
    """Each row's token count, checksums of its pieces, and ranks of its pieces within its input partition."""
    end = np.array([end_id], "<u4").tobytes()

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer, remembered), TaskContext.get().partitionId()
        ranks: Counter = Counter()
        full = 0
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                ids = enc.ids([text.as_py() or ""])[0] + end
                n = len(ids) // 4
                whole, rest = divmod(n, capacity)
                crcs = [zlib.crc32(ids[at:at + 4 * capacity]) for at in range(0, len(ids), 4 * capacity)]
                rows.append((n, full, rest, ranks[rest] if rest else 0, np.array(crcs, "<u4").tobytes()))
                full += whole
                if rest:
                    ranks[rest] += 1
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1"), batch.column("k2"), batch.column("doc_id"), pa.array(cols[0], pa.int64()),
                 pa.array([part] * len(rows), pa.int32()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.binary())],
                names=["k1", "k2", "doc_id", "n", "part", "full_rank", "rest", "rest_rank", "crcs"])

    return docs.mapInArrow(size, SIZED)


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", capacity: int = CAPACITY,
         end_id: int = END_ID, remembered: int | None = None) -> DataFrame:
    """One row per piece: k1, k2, doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its whole text (null and empty: none) and
    ``end_id``, so every row has at least one piece; repeated rows are packed
    each for itself. Each id lies in exactly one piece, and pieces fill a
    sequence gapless from offset 0. Sequences have ``capacity`` ids but for
    the last few, whose lengths are powers of two. An empty table has no pieces.
    ``remembered`` bounds the encoder's memory (see ``tokens.encoder``), not the result.
    """
    named = keyed(docs)
    sized = written(sized_documents(named, tokenizer, capacity, end_id, remembered), "sized")
    by_part = (sized.filter("rest > 0").groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n"))
               .union(sized.groupBy("part").agg(F.sum(F.floor(F.col("n") / capacity)).alias("n"))
                      .select("part", F.lit(capacity).alias("rest"), "n")))
    by_part = written(by_part, "lengths")
    # at most `capacity` rows, whatever the input
    histogram = {r.rest: r.n for r in by_part.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    histogram.pop(capacity, None)
    plan = minimum_slack_plan(histogram, capacity)
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.select("part", "rest", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    full_base = base.filter(F.col("rest") == capacity).select("part", F.col("base").alias("full_base"))
    placed = (sized.join(base, ["part", "rest"], "left").join(full_base, "part", "left")
              .select("k1", "k2", "doc_id", "n", "rest", (F.col("rest_rank") + F.coalesce("base", F.lit(0))).alias("rank"),
                      (F.col("full_rank") + F.col("full_base")).alias("full"), "crcs"))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = {length: [p[0] for p in places] for length, places in plan.places.items()}
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                crcs = np.frombuffer(r["crcs"], "<u4").tolist()
                key = r["k1"], r["k2"], r["doc_id"]
                whole = r["n"] // capacity
                for i in range(whole):
                    out.append((*key, i * capacity, capacity, crcs[i], r["n"], plan.first_full + r["full"] + i, 0))
                length, rank = r["rest"], r["rank"]
                if not length:
                    continue
                first = whole * capacity
                if length in plan.laid and rank >= plan.laid[length][0]:
                    from_rank, position = plan.laid[length]
                    parts = plan.cuts(position + (rank - from_rank) * length, length)
                else:
                    at, n, window, offset = plan.places[length][bisect.bisect_right(starts[length], rank) - 1]
                    nth, slot = divmod(rank - at, n)
                    parts = [(length, window + nth, offset + slot * length)]
                for size, window, offset in parts:
                    out.append((*key, first, size, crcs[whole] if size == length else None, r["n"], window, offset))
                    first += size
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=PIECE_NAMES)

    pieces = written(placed.mapInArrow(expand, PIECES), "pieces")
    # pieces cut at a window's border: their ids are taken from the text once more
    cut = pieces.filter("ids_crc32 is null")
    keys = cut.select("k1", "k2").distinct()
    texts = named.select("k1", "k2", "text").join(keys, ["k1", "k2"]).dropDuplicates(["k1", "k2"])

    def checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        enc = encoder(tokenizer)
        for batch in batches:
            crcs = []
            for text, start, length in zip(*(batch.column(c).to_pylist() for c in ("text", "start", "length"))):
                ids = enc.ids([text or ""])[0] + end
                crcs.append(zlib.crc32(ids[4 * start:4 * (start + length)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(crcs, pa.int64()) if c == "ids_crc32" else batch.column(c) for c in PIECE_NAMES],
                names=PIECE_NAMES)

    mended = cut.join(texts, ["k1", "k2"]).select(*PIECE_NAMES, "text").mapInArrow(checksum, PIECES)
    return pieces.filter("ids_crc32 is not null").union(mended)


PIECE_NAMES = [c.split()[0] for c in PIECES.split(", ")]


def packed_sequences(pieces: DataFrame, docs: DataFrame, tokenizer: str = "byte_bpe_50k.json",
                     end_id: int = END_ID) -> DataFrame:
    """(sequence_id, ids): the token ids of every sequence, little-endian unsigned 32-bit, from ``pack``'s pieces."""
    texts = keyed(docs).select("k1", "k2", "text").dropDuplicates(["k1", "k2"])
    end = np.array([end_id], "<u4").tobytes()

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            ids = []
            for text, start, length in zip(*(batch.column(c).to_pylist() for c in ("text", "start", "length"))):
                ids.append((enc.ids([text or ""])[0] + end)[4 * start:4 * (start + length)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), batch.column("offset"), pa.array(ids, pa.binary())],
                names=["sequence_id", "offset", "ids"])

    parts = (pieces.join(texts, ["k1", "k2"]).select("sequence_id", "offset", "start", "length", "text")
             .mapInArrow(ids_of, "sequence_id long, offset long, ids binary"))
    # a sequence has at most `capacity` ids
    return parts.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p")).select(
        "sequence_id", F.expr("aggregate(p, X'', (acc, x) -> acc || x.ids)").alias("ids"))
