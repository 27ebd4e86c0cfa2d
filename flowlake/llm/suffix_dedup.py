"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered only through ``threshold`` bytes, by most-significant-digit
passes: a pass sorts what is left by its next digit, a suffix alone in its
bucket is settled and leaves, and suffixes still in one bucket at depth
``threshold`` start the same repeated window.

Sorting every suffix of every text would move many times the input, so the
passes work on runs of neighbouring suffixes. Each window has an anchor, the
smallest hash of ``digit`` bytes in it; as the anchor depends on the window's
bytes alone, equal windows have it at the same place. Consecutive windows with
a common anchor are one run.

* Pass 1, digits = the anchor's bytes, then the whole stretch of the run: runs
  with a lone anchor leave; runs of one bucket hold the same windows, so all of
  them are repeated; of the other runs, one of each stretch goes on.
* Pass 2, the runs cut into parts of ``PART`` windows, placed alike to the
  anchor. Digits = the bytes that all of a part's windows share, then all bytes
  they cover; decided as in pass 1.
* Pass 3, digits = the shared bytes, then each single window's bytes before and
  after them: at full depth, equal windows are repeated.

Each pass is one distributed sort, cut into ranges of equal size even where one
string fills many of them. Digits are compared as 64-bit hashes of their bytes,
two of them before anything is called repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import U64, RangeHash, arrow_bytes, by_way_of, gathered, internal, keyed, mix64, row_keys, words_of, written

PIECE = 1 << 18
PART = 8
ROWS = "d1 long, d2 long, k1 long, k2 long, lo long, n short, lead short, left long, right long"
FOUND = "kind byte, k1 long, k2 long, lo long, n short, lead short, d1 long, d2 long, left long, right long"
WHOLE, OPEN, EDGE = 1, 2, 3


def _batch(schema: str, columns: dict, n: int) -> pa.RecordBatch:
    """Columns by the names of a schema; missing ones are null."""
    kinds = {"long": pa.int64(), "short": pa.int16(), "byte": pa.int8()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(n, kinds[kind])
         for name, kind in fields], names=[name for name, _ in fields])


def pieces(offsets: np.ndarray, threshold: int) -> Iterator[list[tuple[int, int, int]]]:
    """Bounded groups of (row, first byte, end) that together hold every window of every row.

    A long row gives several pieces, overlapping so that each window lies whole in one.
    """
    group, size = [], 0
    for row in range(len(offsets) - 1):
        length = int(offsets[row + 1] - offsets[row])
        for first in range(0, length - threshold + 1, PIECE):
            end = min(length, first + PIECE + threshold - 1)
            group.append((row, first, end))
            size += end - first
            if size >= PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


def runs_of(buf: np.ndarray, owner: np.ndarray, threshold: int, digit: int):
    """Runs of a buffer of texts end to end; owner: the text of each byte.

    Gives (lo, n, anchor position) of each run of windows buf[p:p + threshold], lo <= p < lo + n.
    """
    grams = RangeHash(buf).sliding(digit)
    width = threshold - digit + 1
    n = len(buf) - threshold + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    place = U64((1 << 20) - 1)
    value = (grams & ~place) | np.arange(len(grams), dtype=U64)
    blocks = -(-len(value) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, U64)
    padded[:len(value)] = value
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[width - 1:width - 1 + n])
    anchor = (least & place).astype(np.int64)
    whole = owner[:n] == owner[threshold - 1:threshold - 1 + n]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1]) | (owner[1:n] != owner[:n - 1])
    lo = np.flatnonzero(new)
    length = np.diff(np.append(lo, n))
    real = whole[lo]
    return lo[real], length[real], anchor[lo[real]]


def _joined(buf, offsets, group):
    parts = [buf[offsets[row] + first:offsets[row] + end] for row, first, end in group]
    sizes = np.array([len(p) for p in parts])
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes), np.cumsum(sizes) - sizes


def word_symbols(column) -> tuple[np.ndarray, np.ndarray]:
    """The words of a string column end to end, as 64-bit hashes, and the rows' offsets in them."""
    buf, offsets = arrow_bytes(column)
    start, word = words_of(buf[:offsets[-1]], offsets)
    return word, np.searchsorted(start, offsets)


def suffix_runs(docs: DataFrame, threshold: int, digit: int, symbols=arrow_bytes) -> DataFrame:
    """Pass 1's rows: every run of every text; lo: its first window, n: windows, lead: from there to the anchor.

    symbols: what a text is made of, bytes or words.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = symbols(batch.column("text"))
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            for group in pieces(offsets, threshold):
                text, owner, base = _joined(buf, offsets, group)
                lo, n, anchor = runs_of(text, owner, threshold, digit)
                hashes, lead = RangeHash(text, 2), anchor - lo
                piece = owner[lo]
                row = np.array([g[0] for g in group])[piece]
                first = np.array([g[1] for g in group])[piece]
                stretch = hashes.of(lo, lo + n + threshold - 1) + (n * threshold + lead).astype(U64)
                yield _batch(ROWS, {
                    "d1": hashes.of(anchor, anchor + digit).view(np.int64), "d2": mix64(stretch).view(np.int64),
                    "k1": k1[row], "k2": k2[row], "lo": lo - base[piece] + first,
                    "n": n.astype(np.int16), "lead": lead.astype(np.int16)}, len(lo))

    return docs.select("k1", "k2", "text").mapInArrow(scan, ROWS).select("d1", "d2", "k1", "k2", "lo", "n", "lead")


def run_parts(open_rows: DataFrame, threshold: int) -> DataFrame:
    """Pass 2's rows: the open runs (arrays lo, n, lead beside k1, k2, text) cut into parts.

    Part j of an anchor holds the windows that start PART * j + i bytes before
    it, 0 <= i < PART. left and right are the PART - 1 bytes before and after
    what they share, nearest first.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            for at in range(batch.num_rows):
                lo, n, lead = (batch.column(c)[at].values.to_numpy().astype(np.int64) for c in ("lo", "n", "lead"))
                text = buf[offsets[at]:offsets[at + 1]]
                order = np.argsort(lo, kind="stable")
                lo, n, lead = lo[order], n[order], lead[order]
                for stretch in np.split(np.arange(len(lo)), np.flatnonzero(np.diff(lo // PIECE)) + 1):
                    a, m, before = lo[stretch], n[stretch], lead[stretch]
                    begin, end = int(a[0]), int((a + m).max()) + threshold - 1
                    yield parts_of(text[begin:end], a - begin, m, before, begin,
                                   batch.column("k1")[at].as_py(), batch.column("k2")[at].as_py())

    def parts_of(text, lo, n, lead, begin, k1, k2):
        first, last = (lead - n + 1) // PART, lead // PART
        parts = last - first + 1
        run = np.repeat(np.arange(len(lo)), parts)
        j = first[run] + np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
        anchor = (lo + lead)[run]
        shared = anchor - PART * j  # where the shared bytes begin; window i begins i bytes before
        least = np.maximum(anchor - (lo + n - 1)[run] - PART * j, 0)
        most = np.minimum(anchor - lo[run] - PART * j, PART - 1)
        hashes = RangeHash(text, 2)
        size = threshold - PART + 1
        padded = np.concatenate([np.zeros(PART, np.uint8), text, np.zeros(PART, np.uint8)]).astype(U64)
        left = sum(padded[shared + PART - 1 - t] << U64(8 * t) for t in range(PART - 1))
        right = sum(padded[shared + size + PART + t] << U64(8 * t) for t in range(PART - 1))
        cover = hashes.of(shared - most, shared + threshold - least)
        return _batch(ROWS, {
            "d1": hashes.of(shared, shared + size).view(np.int64),
            "d2": mix64(cover + (least * PART + most).astype(U64)).view(np.int64),
            "k1": np.full(len(run), k1), "k2": np.full(len(run), k2), "lo": shared - most + begin,
            "n": (most - least + 1).astype(np.int16), "lead": most.astype(np.int16),
            "left": left.view(np.int64), "right": right.view(np.int64)}, len(run))

    return open_rows.mapInArrow(scan, ROWS)


def part_windows(parts: DataFrame) -> DataFrame:
    """Pass 3's rows: the single windows of the open parts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {c: batch.column(c).to_numpy() for c in ("d1", "k1", "k2", "lo", "n", "lead", "left", "right")}
            n = col["n"].astype(np.int64)
            row = np.repeat(np.arange(len(n)), n)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            i = (col["lead"][row] - nth).astype(U64)  # bytes before the shared ones
            left = col["left"].view(U64)[row] & ((U64(1) << (U64(8) * i)) - U64(1))
            right = col["right"].view(U64)[row] & ((U64(1) << (U64(8) * (U64(PART - 1) - i))) - U64(1))
            d2 = mix64(mix64(left + (i << U64(57))) + right)
            yield _batch(ROWS, {"d1": col["d1"][row], "d2": d2.view(np.int64), "k1": col["k1"][row],
                                "k2": col["k2"][row], "lo": col["lo"][row] + nth,
                                "n": np.ones(len(row), np.int16)}, len(row))

    return parts.mapInArrow(scan, ROWS).select("d1", "d2", "k1", "k2", "lo", "n", "lead")


def word_windows(open_rows: DataFrame, words: int) -> DataFrame:
    """The last pass's rows for passages: the single windows of the open runs (arrays lo, n beside k1, k2, text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, offsets = word_symbols(batch.column("text"))
            for at in range(batch.num_rows):
                lo, n = (batch.column(c)[at].values.to_numpy().astype(np.int64) for c in ("lo", "n"))
                text = symbols[offsets[at]:offsets[at + 1]]
                window = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                d1, d2 = (RangeHash(text, seed).of(window, window + words).view(np.int64) for seed in (1, 2))
                yield _batch(ROWS, {
                    "d1": d1, "d2": d2, "k1": np.full(len(window), batch.column("k1")[at].as_py()),
                    "k2": np.full(len(window), batch.column("k2")[at].as_py()), "lo": window,
                    "n": np.ones(len(window), np.int16)}, len(window))

    return open_rows.mapInArrow(scan, ROWS).select("d1", "d2", "k1", "k2", "lo", "n", "lead")


def radix_pass(rows: DataFrame, last: bool = False) -> DataFrame:
    """Sort by the two digits and tell what is repeated (WHOLE) and what must go on (OPEN).

    A row is WHOLE if another has both its digits. One row of each second digit
    is OPEN where a first digit has several; at the ends of a range, where the
    neighbours are not seen, always. Rows alone in their bucket leave. In the
    last pass nothing goes on: what stands at the ends of ranges is given as
    EDGE, to be counted by its digits.
    """
    rows = rows.withColumns({c: F.lit(None).cast("long") for c in ("left", "right") if c not in rows.columns})

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Goes through a sorted range holding a stretch of it, the row before it, and at most one row of the open bucket."""
        before = None  # the last row so far, still to be told whether the next one repeats it
        before_repeats = False  # whether it repeats the one before it
        seconds, held = 2, None  # second digits in the open bucket; its first row, while there is only one of them
        for rows in gathered(batches):
            d1, d2 = (rows.column(c).to_numpy() for c in ("d1", "d2"))
            if before is None:
                if last:
                    yield found(EDGE, rows.slice(0, 1))
                same1 = same2 = False
            else:
                same1 = before.column("d1")[0].as_py() == d1[0]
                same2 = same1 and before.column("d2")[0].as_py() == d2[0]
                if same2 or before_repeats:
                    yield found(WHOLE, before)
            same1 = np.append(same1, d1[1:] == d1[:-1])
            same2 = np.append(same2, same1[1:] & (d2[1:] == d2[:-1]))
            whole = same2 | np.append(same2[1:], False)
            whole[-1] = False
            yield found(WHOLE, rows.filter(pa.array(whole)))
            if not last:
                bucket = np.cumsum(~same1)  # 0: the one that was open
                digits = np.bincount(bucket, weights=~same2, minlength=1).astype(np.int64)
                # the first bucket of a range may have begun in the range before
                digits[0] += seconds if before is not None else 0
                if before is None:
                    digits[1] = 2
                if digits[0] > 1 and held is not None:
                    yield found(OPEN, held)
                    held = None
                yield found(OPEN, rows.filter(pa.array(~same2 & (digits > 1)[bucket])))
                seconds = int(digits[-1])
                if bucket[-1] > 0:
                    held = None
                if seconds == 1 and held is None:
                    held = rows.slice(int(np.flatnonzero((bucket == bucket[-1]) & ~same2)[0]), 1)
            before, before_repeats = rows.slice(rows.num_rows - 1), bool(same2[-1])
        if before is not None:
            if before_repeats:
                yield found(WHOLE, before)
            if last:
                yield found(EDGE, before)
            elif held is not None:  # the last bucket may go on in the next range
                yield found(OPEN, held)

    def found(kind: int, rows: pa.RecordBatch) -> pa.RecordBatch:
        columns = {c: rows.column(c) for c in rows.schema.names if kind != WHOLE or c in ("k1", "k2", "lo", "n")}
        return _batch(FOUND, columns | {"kind": np.full(rows.num_rows, kind, np.int8)}, rows.num_rows)

    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["d1", "d2", "k1", "k2", "lo"]
    return rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order).mapInArrow(mark, FOUND)


def _stretches(found: DataFrame) -> DataFrame:
    return found.filter(F.col("kind") == WHOLE).select("k1", "k2", "lo", (F.col("lo") + F.col("n")).alias("hi"))


def repeated_windows(docs: DataFrame, threshold: int = 400, digit: int = 128, keep_runs: bool = False) -> tuple[DataFrame, DataFrame]:
    """Every repeated window, and the texts that have any.

    First: (k1, k2, lo, hi), stretches of window starts lo <= p < hi whose
    window also starts elsewhere; some may be listed twice. Second: (k1, k2,
    text, ...), one row for each distinct row of ``docs`` (k1, k2, text as of
    ``keyed``) that can have a stretch. keep_runs: whether pass 1's rows are
    written before they are sorted, which takes disk and saves a second scan of
    the texts; the result is the same.
    """
    runs = suffix_runs(docs, threshold, digit)
    first = by_way_of(runs, "runs", radix_pass, "pass1") if keep_runs else written(radix_pass(runs), "pass1")
    affected = written(_affected(docs, first, ("lo", "n", "lead")), "affected")
    second = written(radix_pass(run_parts(affected.filter("size(lo) > 0"), threshold)), "pass2")
    third = written(radix_pass(part_windows(second.filter(F.col("kind") == OPEN)), last=True), "pass3")
    return _stretches(first).union(_stretches(second)).union(_stretches(third)).union(_across(third)), affected


def _affected(docs: DataFrame, first: DataFrame, columns: tuple) -> DataFrame:
    """k1, k2, text of the distinct rows with a run told of in pass 1, and arrays of their open runs."""
    is_open = F.col("kind") == OPEN
    per_row = first.groupBy("k1", "k2").agg(
        # at most one entry for each run of the row
        *[F.collect_list(F.when(is_open, F.col(c))).alias(c) for c in columns])
    # identical rows share their keys; their runs were told as repeated in pass 1
    return docs.select("k1", "k2", "text").join(per_row, ["k1", "k2"]).dropDuplicates(["k1", "k2"])


def _across(last_pass: DataFrame) -> DataFrame:
    """Stretches that repeat over the ends of the last pass's ranges."""
    edges = last_pass.filter(F.col("kind") == EDGE).select("d1", "d2", "k1", "k2", "lo", "n").distinct()
    twice = edges.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("places")).filter("places > 1")
    return edges.join(twice, ["d1", "d2"], "left_semi").select("k1", "k2", "lo", (F.col("lo") + F.col("n")).alias("hi"))


def passage_words(docs: DataFrame, words: int = 51) -> DataFrame:
    """(k1, k2, n_passage_words): how many words of a row lie in a passage of ``words`` words that also stands elsewhere.

    The same sort with words for bytes (ASCII white space separates them): one
    pass over runs of windows, one over the single windows of what it leaves
    open. Passages never cross rows; rows without any are left out. docs as of
    ``keyed``; a repeated row is a copy of itself.
    """
    first = by_way_of(suffix_runs(docs, words, max(words // 3, 1), word_symbols), "passage-runs", radix_pass, "passages1")
    open_rows = written(_affected(docs, first, ("lo", "n")).filter("size(lo) > 0"), "passages-open")
    second = written(radix_pass(word_windows(open_rows, words), last=True), "passages2")
    found = _stretches(first).union(_stretches(second)).union(_across(second))
    # a row's stretches are at most as many as its words
    per_row = found.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("s"))
    zero = F.lit(0).cast("long")

    def add(so_far, x):
        begin, end = F.greatest(x.lo, so_far.end), x.hi + (words - 1)
        return F.struct((so_far.n + F.greatest(end - begin, zero)).alias("n"), F.greatest(so_far.end, end).alias("end"))

    return per_row.select("k1", "k2", F.aggregate("s", F.struct(zero.alias("n"), zero.alias("end")), add).n.alias("n_passage_words"))


def cut_rows(docs: DataFrame, threshold: int, digit: int, keep_runs: bool = False) -> DataFrame:
    """k1, k2 and ``cut`` (see ``cut_text``) of the distinct rows that lose bytes; docs as of ``keyed``."""
    stretches, texts = repeated_windows(docs, threshold, digit, keep_runs)
    # a row's stretches are at most as many as its windows
    per_row = (stretches.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("s"))
               .select("k1", "k2", F.expr("transform(s, x -> x.lo)").alias("from"),
                       F.expr("transform(s, x -> x.hi)").alias("to")))
    return (texts.select("k1", "k2", "text").join(per_row, ["k1", "k2"])
            .select("k1", "k2", cut_text(threshold)("text", "from", "to").alias("cut")))


def cut_text(threshold: int):
    """Column function (text, lo, hi) -> n_removed, n_spans, kept_sha256, kept."""

    @F.pandas_udf("n_removed long, n_spans long, kept_sha256 string, kept binary")
    def cut(texts: pd.Series, los: pd.Series, his: pd.Series) -> pd.DataFrame:
        rows = []
        for text, lo, hi in zip(texts, los, his):
            raw = text.encode()
            hi = np.maximum.accumulate(hi + (threshold - 1))
            gap = np.flatnonzero(lo[1:] > hi[:-1])
            begin, end = lo[np.append(0, gap + 1)], hi[np.append(gap, len(hi) - 1)]
            kept = b"".join(raw[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(raw)]))
            rows.append((len(raw) - len(kept), len(begin), hashlib.sha256(kept).hexdigest(), kept))
        return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256", "kept"])

    return cut


def remove_repeats(docs: DataFrame, threshold: int = 400, digit: int = 128, passage: int | None = None) -> DataFrame:
    """Each row's text without the bytes that lie in a repeated ``threshold``-byte window.

    With ``passage``, also n_passage_words: the words that lie in a repeated
    passage of that many words, which may have fewer bytes and then stay.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 and kept (the remaining bytes where any were removed, else
    null). Windows never cross rows and are judged on the input; overlaps
    count, also within one row. Null and empty texts have no bytes. Repeated
    rows are copies of each other, so all their windows are repeated. Only
    doc_id and text are read.
    """
    named = keyed(docs)
    cut = cut_rows(named, threshold, digit, keep_runs=True)
    raw = F.coalesce("text", F.lit("")).cast("binary")
    whole = named.select("k1", "k2", "doc_id", F.octet_length(raw).cast("long").alias("n_bytes"),
                         F.sha2(raw, 256).alias("sha256"))
    if passage:
        whole = whole.join(passage_words(named, passage), ["k1", "k2"], "left")
    return (whole.join(cut, ["k1", "k2"], "left")
            .select("doc_id", "n_bytes", F.coalesce("cut.n_removed", F.lit(0)).alias("n_removed"),
                    F.coalesce("cut.n_spans", F.lit(0)).alias("n_spans"),
                    F.coalesce("cut.kept_sha256", "sha256").alias("kept_sha256"), F.col("cut.kept").alias("kept"),
                    *[F.coalesce("n_passage_words", F.lit(0)).alias("n_passage_words")] * bool(passage)))


def without_repeats(docs: DataFrame, threshold: int = 400, digit: int = 128) -> DataFrame:
    """``docs`` with all its columns, text cut as by ``remove_repeats`` and n_chars, if there, counted anew.

    Bytes of a character of which only a part was removed go too. Null texts stay null.
    """
    key = {c: internal(docs, c) for c in ("k1", "k2", "kept")}
    found = (cut_rows(keyed(docs), threshold, digit)
             .select("k1", "k2", whole_characters("cut.kept").alias("kept")).withColumnsRenamed(key))
    k1, k2 = row_keys(F.col("doc_id").cast("long"), F.col("text"))
    marked = (docs.withColumns({key["k1"]: k1, key["k2"]: k2}).join(found, [key["k1"], key["k2"]], "left")
              .withColumn("text", F.coalesce(key["kept"], "text")))
    if "n_chars" in docs.columns:
        marked = marked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return marked.select(*[F.col(f"`{c}`") for c in docs.columns])


@F.pandas_udf(StringType())
def whole_characters(raw: pd.Series) -> pd.Series:
    """UTF-8 bytes as text, without bytes that are no whole character."""
    return raw.map(lambda b: None if b is None else b.decode(errors="ignore"))
