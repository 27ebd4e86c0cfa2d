"""Fill-in-the-middle transformation by displacement scatter.

A batch's texts lie end to end in one byte buffer. Two cuts split a text into
prefix, middle and suffix; a prefix-suffix-middle (psm) or suffix-prefix-middle
(spm) document is these pieces in another order, each after its mark. Within a
piece every byte moves by the same amount, so an array that is zero but for
where a piece begins, holding there by how much the displacement changes,
gives every byte its displacement as a cumulative sum, and one scatter puts all
bytes of the batch into the output. Restoring finds the marks in the output,
derives the same displacements from them alone, and gathers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import arrow_bytes, row_groups, short_batches

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"])
#: bytes of texts that are moved at a time (a longer text is moved in windows of this size)
GROUP = 1 << 21


def draws(doc_ids: list, seed: int) -> np.ndarray:
    """Four unsigned 32-bit numbers for each id, from the SHA-256 of ``seed:id`` (null id: ``seed:``)."""
    raw = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in doc_ids)
    return np.frombuffer(raw, dtype=">u4").reshape(-1, 4).astype(np.int64)


def mark_places(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where marks begin in texts end to end, and the byte that tells which mark each is."""
    at = np.flatnonzero(buf[:len(buf) - 2] == ord("<")) if len(buf) > 2 else np.zeros(0, np.int64)
    which = buf[at + 1]
    at = at[(buf[at + 2] == ord(">")) & ((which == PREFIX[1]) | (which == SUFFIX[1]) | (which == MIDDLE[1]))]
    row = np.searchsorted(offsets, at, side="right") - 1
    at = at[at + MARK <= offsets[row + 1]]  # not over the end of a text
    return at, buf[at + 1]


def code_point_starts(buf: np.ndarray) -> np.ndarray:
    """Places of the first bytes of UTF-8 code points."""
    return np.flatnonzero((buf & 0xC0) != 0x80)


def displaced(size: int, begin: np.ndarray, shift: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, end, target of every byte in between) over a buffer of ``size`` bytes, in windows.

    begin: ascending places at which ``shift`` takes effect; several at one
    place: the last one holds (the pieces before it are empty).
    """
    change = np.diff(shift, prepend=0)
    for first in range(0, size, GROUP):
        end = min(size, first + GROUP)
        a, b = np.searchsorted(begin, [first, end])
        steps = np.zeros(end - first, np.int64)
        np.add.at(steps, begin[a:b] - first, change[a:b])
        if a:
            steps[0] += shift[a - 1]
        np.cumsum(steps, out=steps)
        steps += np.arange(first, end)
        yield first, end, steps


def scatter(buf: np.ndarray, offsets: np.ndarray, cut1: np.ndarray, cut2: np.ndarray, form: np.ndarray):
    """Output bytes and their offsets; cut1 <= cut2: byte places in ``buf`` where middle and suffix begin."""
    lo, hi = offsets[:-1], offsets[1:]
    marked = form != PLAIN
    ends = np.concatenate([[0], np.cumsum(hi - lo + 3 * MARK * marked)])
    start, prefix, middle, suffix = ends[:-1], cut1 - lo, cut2 - cut1, hi - cut2
    spm = form == SPM
    to_prefix = start + np.where(spm, 2 * MARK + suffix, np.where(marked, MARK, 0))
    to_suffix = start + np.where(spm, MARK, np.where(marked, 2 * MARK + prefix, prefix + middle))
    to_middle = np.where(marked, start + 3 * MARK + prefix + suffix, start + prefix)
    begin = np.stack([lo, cut1, cut2], axis=1).ravel()
    shift = np.stack([to_prefix - lo, to_middle - cut1, to_suffix - cut2], axis=1).ravel()
    out = np.zeros(ends[-1], np.uint8)
    for first, end, target in displaced(len(buf), begin, shift):
        out[target] = buf[first:end]
    for mark, place in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        for i, byte in enumerate(mark):
            out[(place - MARK + i)[marked]] = byte
    return out, ends


def restore(out: np.ndarray, ends: np.ndarray, form: np.ndarray):
    """The texts again, as bytes and offsets, from the outputs and their forms alone."""
    at, which = mark_places(out, ends)
    row = np.searchsorted(ends, at, side="right") - 1
    marked = form != PLAIN
    real = marked[row]  # a plain text may hold anything
    at, which, row = at[real], which[real], row[real]
    if not np.array_equal(np.bincount(row, minlength=len(form)), 3 * marked):
        raise ValueError("an output does not hold the marks of its form")
    place = {}
    for mark in (PREFIX, SUFFIX, MIDDLE):
        mine = which == mark[1]
        place[mark] = np.zeros(len(form), np.int64)
        place[mark][row[mine]] = at[mine] + MARK
    start, stop, spm = ends[:-1], ends[1:], form == SPM
    offsets = np.concatenate([[0], np.cumsum(stop - start - 3 * MARK * marked)])
    lo = offsets[:-1]
    from_prefix = np.where(marked, place[PREFIX], start)
    from_suffix = np.where(marked, place[SUFFIX], stop)
    from_middle = np.where(marked, place[MIDDLE], stop)
    prefix = np.where(marked, np.where(spm, place[MIDDLE], place[SUFFIX]) - MARK - from_prefix, stop - start)
    suffix = np.where(marked, np.where(spm, place[PREFIX], place[MIDDLE]) - MARK - from_suffix, 0)
    middle = np.where(marked, stop - from_middle, 0)
    begin = np.stack([lo, lo + prefix, lo + prefix + middle], axis=1).ravel()
    shift = np.stack([from_prefix, from_middle, from_suffix], axis=1).ravel() - begin
    buf = np.zeros(offsets[-1], np.uint8)
    for first, end, source in displaced(len(buf), begin, shift):
        buf[first:end] = out[source]
    return buf, offsets


def transform(buf: np.ndarray, offsets: np.ndarray, doc_ids: list, seed: int, plain_percent: int, spm_percent: int) -> dict:
    """n, form, prefix_chars, middle_chars and the outputs of texts end to end (offsets from 0)."""
    starts = code_point_starts(buf)
    first = np.searchsorted(starts, offsets)
    n = np.diff(first)
    h = draws(doc_ids, seed)
    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    one, two = np.minimum(one, two), np.maximum(one, two)
    at, _ = mark_places(buf, offsets)
    has_mark = np.zeros(len(n), bool)
    has_mark[np.searchsorted(offsets, at, side="right") - 1] = True
    form = np.where(h[:, 3] % 100 < spm_percent, SPM, PSM)
    form[(n == 0) | has_mark | (h[:, 2] % 100 >= 100 - plain_percent)] = PLAIN
    places = np.append(starts, len(buf))
    cut = [np.where(form == PLAIN, offsets[1:], np.minimum(places[first[:-1] + k], offsets[1:])) for k in (one, two)]
    out, ends = scatter(buf, offsets, *cut, form)
    return {"n": n, "form": form, "prefix_chars": one, "middle_chars": two - one, "out": out, "ends": ends}


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """Each row's text rearranged for filling in the middle.

    Returns doc_id (long), n (code points), form (``plain``, ``psm`` or
    ``spm``), prefix_chars and middle_chars (null if plain) and ``output``
    (string). Cuts and form follow from ``seed`` and doc_id alone, so copies of
    a row and a repeated task give the same output; rows with a null id share
    one draw. A text is plain if it is null or empty, holds a mark, or for
    ``plain_percent`` of the ids; ``spm_percent`` of the others are spm. Only
    doc_id and text are read. No shuffle: every batch is transformed where it is read.
    """
    short_batches(docs.sparkSession)
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            ids = batch.column("doc_id")
            for lo, hi in row_groups(offsets, GROUP):
                own = offsets[lo:hi + 1] - offsets[lo]
                got = transform(buf[offsets[lo]:offsets[hi]], own, ids.slice(lo, hi - lo).to_pylist(),
                                seed, plain_percent, spm_percent)
                plain = pa.array(got["form"] == PLAIN)
                null = pa.scalar(None, pa.int64())
                output = pa.Array.from_buffers(pa.large_utf8(), hi - lo, [
                    None, pa.py_buffer(got["ends"].astype(np.int64)), pa.py_buffer(got["out"])])
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, hi - lo), pa.array(got["n"], pa.int64()), pa.array(FORMS[got["form"]]),
                    *[pc.if_else(plain, null, pa.array(got[c], pa.int64())) for c in ("prefix_chars", "middle_chars")],
                    output.cast(pa.string())], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


@F.arrow_udf(StringType())
def restored_text(output: pa.Array, form: pa.Array) -> pa.Array:
    """The text that became ``output`` in this form (see ``fill_in_middle``)."""
    out, ends = arrow_bytes(output)
    kind = np.searchsorted(FORMS, np.array(form.to_pylist(), dtype=FORMS.dtype))
    parts = []
    for lo, hi in row_groups(ends, GROUP):
        buf, offsets = restore(out[ends[lo]:ends[hi]], ends[lo:hi + 1] - ends[lo], kind[lo:hi])
        parts.append(pa.Array.from_buffers(pa.large_utf8(), hi - lo, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(buf)]))
    return pa.concat_arrays(parts).cast(pa.string()) if parts else pa.array([], pa.string())


def transform_digests(docs: DataFrame, seed: int = 1) -> DataFrame:
    """``fill_in_middle`` with checksums of the outputs and of the texts restored from them."""
    done = fill_in_middle(docs, seed)
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored_text("output", "form").cast("binary"), 256).alias("restored_sha256"))
