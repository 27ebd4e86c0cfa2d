"""Spelling variants: words one edit apart, by dynamic programming over the sorted vocabulary.

The vocabulary is sorted and cut into segments. Within a segment, the words
between two places where the longest common prefix (LCP) of neighbours falls
below d share their first d letters, and so share the rows 1 to d of the edit
matrix against a query word: a row is computed once for such a range and reused
for all its words. Rows are banded, three cells wide, as more than one edit is
of no interest. A range whose prefix already is more than one edit away from
every prefix of the query is skipped with all its words; a range that goes on
is cut where its words next differ, which the LCPs tell. Many queries walk the
list together, one letter at a time, so that all of a step is array work.

One edit leaves the first half of a word or its second half as it was. Queries
therefore walk two lists: that of the words, where they enter below their own
first half, and that of the reversed words, where they enter below their
reversed second half. The same walk over the segments' first words tells which
segments a query has to see; a frequent beginning spreads over many segments,
and each query still meets only those that can hold a word near it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import short_batches, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
NOT_IN_RUN = re.compile("[^A-Za-zÀ-ÿ]")
LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}
#: code points of a text that are looked at a time, up to the end of a run
SLICE = 1 << 20
#: counts held before they are sent on
HELD = 200_000
#: words of a segment, and queries that walk together
SEGMENT, TOGETHER = 20_000, 4_000
#: letters of a half that are looked up at once, and to which segment borders are told apart
HALF, BORDER = 32, 64
#: segments that a query is sent to without asking for more letters
FEW = 4


def run_counts(text: str) -> Counter:
    """Lower-cased runs of a text of any length, and how often each stands there."""
    found, at = Counter(), 0
    while at < len(text):
        end = min(at + SLICE, len(text))
        cut = NOT_IN_RUN.search(text, end) if end < len(text) else None
        end = len(text) if end == len(text) or cut is None else cut.start()
        found.update(RUN.findall(text, at, end))
        at = end
    low = Counter()
    for run, n in found.items():
        low[run.lower() if run.isascii() else run.translate(LOWER)] += n
    return low


def thinned(run: str, doc: int, one_in: int) -> str:
    """The run, or for one in ``one_in`` hashes the run without one of its code points; doc: CRC-32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), doc)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least_length: int = 7, least_count: int = 2, one_in: int = 31) -> DataFrame:
    """(word, n) of all words of at least ``least_length`` code points and ``least_count`` occurrences.

    Counts are added up per task before they are shuffled, so frequent words
    move as one row per task.
    """
    short_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def send():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                             names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                doc = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in run_counts(text.as_py() or "").items():
                    if len(run) >= least_length:
                        word = thinned(run, doc, one_in)
                        if len(word) >= least_length:
                            held[word] += n
                if len(held) >= HELD:
                    yield send()
        yield send()

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def first_difference(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the longest common prefix, of which ``at`` bytes are known."""
    n = min(len(a), len(b))
    step = 16
    while at < n:
        if a[at:at + step] == b[at:at + step]:
            at, step = min(at + step, n), step * 2
        elif step > 1:
            step = max(1, step // 4)
        else:
            break
    return at


class SortedList:
    """A sorted list of words (Latin-1 bytes, which sort like code points) with the LCPs of neighbours."""

    def __init__(self, words: list[bytes]):
        self.words, self.size = words, len(words)
        self.length = np.array([len(w) for w in words], np.int64)
        self.flat = np.frombuffer(b"".join(words), np.uint8)
        self.begin = np.cumsum(self.length) - self.length
        self.heads = np.array([w[:HALF] for w in words], dtype=f"S{HALF}")
        self.lcp = np.zeros(self.size + 1, np.int64)
        self.lcp[0] = self.lcp[-1] = -1
        if self.size > 1:
            letters = self.heads.view(np.uint8).reshape(self.size, HALF)
            same = (letters[1:] == letters[:-1]) & (letters[1:] != 0)
            self.lcp[1:-1] = np.where(same.all(axis=1), HALF, np.argmin(same, axis=1))
            for i in np.flatnonzero(self.lcp[1:-1] == HALF) + 1:
                self.lcp[i] = first_difference(words[i - 1], words[i], HALF)
        self.falls: dict[int, np.ndarray] = {}

    def borders(self, depth: int) -> np.ndarray:
        """Where a word has no more than ``depth`` letters in common with the one before it; both ends of the list too."""
        if depth not in self.falls:
            found = np.flatnonzero(self.lcp <= depth)
            if depth > BORDER:
                return found
            self.falls[depth] = found
        return self.falls[depth]

    def below(self, prefixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of the words that begin with each prefix (of at most HALF letters)."""
        width = np.char.str_len(prefixes)
        top = prefixes.view(np.uint8).reshape(len(prefixes), HALF).copy()
        top[np.arange(HALF) >= width[:, None]] = 255
        top = top.reshape(-1).view(f"S{HALF}")
        return np.searchsorted(self.heads, prefixes, side="left"), np.searchsorted(self.heads, top, side="right")

    def letter(self, word: np.ndarray, at: int) -> np.ndarray:
        return self.flat[self.begin[word] + at]


class Walk:
    """Queries of one length on their way down a sorted list.

    query, lo, hi: a query and a range of words that share their first
    ``depth`` letters; row: the three cells of the edit matrix's row ``depth``
    around its diagonal, query letters across, 2 standing for two and more.
    """

    def __init__(self, words: SortedList, queries: np.ndarray, half: int):
        """queries: a row of letters each; they enter below their first ``half`` letters."""
        self.words, self.letters, self.m, self.depth = words, queries, queries.shape[1], half
        heads = np.zeros((len(queries), HALF), np.uint8)
        heads[:, :half] = queries[:, :half]
        self.lo, self.hi = words.below(heads.reshape(-1).view(f"S{HALF}"))
        self.query = np.arange(len(queries))
        self.row = np.ones((3, len(queries)), np.int8)
        self.row[1] = 0
        self.keep(self.lo < self.hi)

    def keep(self, which: np.ndarray) -> None:
        self.query, self.lo, self.hi, self.row = self.query[which], self.lo[which], self.hi[which], self.row[:, which]

    def ended(self) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of the words that end here at a distance of exactly one edit."""
        cell = self.m - self.depth + 1
        if not 0 <= cell <= 2:
            return (np.zeros(0, np.int64),) * 2
        hit = (self.row[cell] == 1) & (self.words.length[self.lo] == self.depth)
        return self.query[hit], self.lo[hit]

    def step(self) -> None:
        """One letter further: ranges are cut where their words differ in it, and left if two edits away."""
        words, d, m = self.words, self.depth, self.m
        borders = words.borders(d)
        first, last = np.searchsorted(borders, self.lo), np.searchsorted(borders, self.hi)
        parts = last - first
        state = np.repeat(np.arange(len(first)), parts)
        part = first[state] + np.arange(len(state)) - np.repeat(np.cumsum(parts) - parts, parts)
        lo, hi = borders[part], borders[part + 1]
        goes_on = words.length[lo] > d
        state, lo, hi = state[goes_on], lo[goes_on], hi[goes_on]
        query, letter = self.query[state], words.letter(lo, d)
        before, on, after = self.row[:, state]
        two = np.full(len(state), 2, np.int8)
        left = np.minimum(before + (self.letters[query, d - 1] != letter), on + 1) if 0 < d <= m else two
        here = np.minimum(np.minimum(on + (self.letters[query, d] != letter), after + 1), left + 1) if d < m else two
        right = np.minimum(after + (self.letters[query, d + 1] != letter), here + 1) if d + 1 < m else two
        self.query, self.lo, self.hi, self.depth = query, lo, hi, d + 1
        self.row = np.minimum(np.stack([left, here, right]), 2).astype(np.int8)
        self.keep(self.row.min(axis=0) <= 1)


def by_length(queries: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, letters) of queries of one length at a time, at most TOGETHER and a few MB of them."""
    lengths = np.array([len(q) for q in queries])
    for m in np.unique(lengths):
        places = np.flatnonzero(lengths == m)
        chunk = max(1, min(TOGETHER, (1 << 22) // int(m)))
        for at in range(0, len(places), chunk):
            some = places[at:at + chunk]
            yield some, np.frombuffer(b"".join(queries[i] for i in some), np.uint8).reshape(len(some), m)


def halves(m: int, backwards: bool) -> int:
    """Letters below which a query of length m enters the list of words, or that of reversed words."""
    ahead = min(m // 2, HALF)
    return min(m - ahead - 1, HALF) if backwards else ahead


def near_pairs(words: SortedList, queries: list[bytes], backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) places of all pairs one edit apart that agree in the query's half.

    backwards: words and queries are reversed; pairs that the other list tells
    of are left out.
    """
    found = []
    for places, letters in by_length(queries):
        m = letters.shape[1]
        walk = Walk(words, letters, halves(m, backwards))
        while len(walk.query) and walk.depth <= m + 1:
            q, w = walk.ended()
            if backwards and len(q):
                ahead = halves(m, False)
                other = np.zeros(len(q), bool)  # differ in the first half of the query
                end = words.begin[w] + words.length[w]
                for t in range(ahead):
                    other |= letters[q, m - 1 - t] != words.flat[end - 1 - t]
                q, w = q[other], w[other]
            found.append((places[q], w))
            walk.step()
    if not found:
        return (np.zeros(0, np.int64),) * 2
    return tuple(np.concatenate(x) for x in zip(*found))


def segments_of(firsts: SortedList, queries: list[bytes], backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, segment) places of the segments that can hold words near each query.

    firsts: the segments' first words, cut to BORDER letters. A segment may
    begin before a prefix and go on into it, so every range of segments is
    taken with the one before.
    """
    out = []

    def take(query, lo, hi):
        count = np.maximum(hi - lo, 0)
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        out.append((np.repeat(query, count), np.repeat(lo, count) + nth))

    for places, letters in by_length(queries):
        m = letters.shape[1]
        heads = np.zeros((len(letters), HALF), np.uint8)
        half = halves(m, backwards)
        heads[:, :half] = letters[:, :half]
        lo, hi = firsts.below(heads.reshape(-1).view(f"S{HALF}"))
        few = hi - lo <= FEW
        take(places[few], lo[few] - 1, hi[few])
        if few.all():
            continue
        walk = Walk(firsts, letters, half)
        walk.keep(~few[walk.query])
        while len(walk.query):
            deep = (walk.hi - walk.lo <= FEW) | (walk.depth >= min(BORDER, m) - 1)
            take(places[walk.query[deep]], walk.lo[deep] - 1, walk.hi[deep])
            walk.keep(~deep)
            if not len(walk.query):
                break
            # words between two segments' beginnings that part here: in the segment before each border
            borders = firsts.borders(walk.depth)
            a, b = np.searchsorted(borders, walk.lo), np.searchsorted(borders, walk.hi)
            count = b - a + 1
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = borders[np.repeat(a, count) + nth]
            take(places[np.repeat(walk.query, count)], at - 1, at)
            walk.step()
    if not out:
        return (np.zeros(0, np.int64),) * 2
    query, segment = (np.concatenate(x) for x in zip(*out))
    real = (segment >= 0) & (segment < firsts.size)
    pairs = np.unique(np.stack([query[real], segment[real]]), axis=1)
    return pairs[0], pairs[1]


def _latin(column) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


def _neighbours(vocabulary: DataFrame, n_words: int, backwards: bool) -> DataFrame:
    """(word, n_near, n, near): how many near words one list tells of, and the most frequent of them, by segment."""
    segments = -(-n_words // SEGMENT) or 1
    key = F.reverse("word") if backwards else F.col("word")
    ordered = (vocabulary.select(key.alias("key"), "n").repartitionByRange(segments, "key")
               .select(F.spark_partition_id().alias("segment"), "key", "n"))
    ordered = written(ordered, "spelling-list")
    # one row a segment, of SEGMENT words each
    firsts = ordered.groupBy("segment").agg(F.min("key").alias("key")).toArrow().sort_by("key")
    numbers = np.array(firsts.column("segment").to_pylist(), np.int64)
    borders = [w[:BORDER] for w in _latin(firsts.column("key"))]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = SortedList(borders)
        for batch in batches:
            query, segment = segments_of(firsts, _latin(batch.column("key")), backwards)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers[segment], pa.int32()), batch.column("key").take(pa.array(query))], names=["segment", "key"])

    sent = ordered.select("key").mapInArrow(send, "segment int, key string")
    rows = ordered.select("segment", F.lit(0).alias("kind"), "key", "n").union(
        sent.select("segment", F.lit(1).alias("kind"), "key", F.lit(None).cast("long").alias("n")))

    turn = slice(None, None, -1 if backwards else 1)

    def answers(words: list[bytes], counts: list, index: SortedList, queries: list[bytes]) -> pa.RecordBatch:
        n = np.concatenate(counts)
        # places of the words in code-point order
        rank = np.argsort(np.argsort(np.array([w[turn] for w in words], object), kind="stable")) if backwards else np.arange(len(words))
        q, w = near_pairs(index, queries, backwards)
        order = np.lexsort((rank[w], -n[w], q))
        q, w = q[order], w[order]
        begin = np.flatnonzero(np.diff(q, prepend=-1))
        best = w[begin]
        return pa.RecordBatch.from_arrays([
            pa.array([queries[i][turn].decode("latin-1") for i in q[begin]], pa.string()),
            pa.array(np.diff(np.append(begin, len(q))), pa.int64()), pa.array(n[best], pa.int64()),
            pa.array([words[i][turn].decode("latin-1") for i in best], pa.string())], names=["word", "n_near", "n", "near"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by segment: its words, sorted, and then its queries, of which SEGMENT at most are held."""
        segment, words, counts, queries, index = None, [], [], [], None
        for batch in batches:
            numbers, kinds = batch.column("segment").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(numbers)]):
                if hi == lo:
                    continue
                keys = _latin(batch.column("key").slice(lo, hi - lo))
                if numbers[lo] != segment or len(queries) >= SEGMENT:
                    if queries:
                        yield answers(words, counts, index, queries)
                    queries = []
                if numbers[lo] != segment:
                    segment, words, counts, index = numbers[lo], [], [], None
                if kinds[lo] == 0:
                    words += keys
                    counts.append(batch.column("n").slice(lo, hi - lo).to_numpy())
                else:
                    index = index or SortedList(words)
                    queries += keys
        if queries:
            yield answers(words, counts, index, queries)

    partitions = max(segments, int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (rows.repartition(partitions, "segment").sortWithinPartitions("segment", "kind", "key")
            .mapInArrow(search, "word string, n_near long, n long, near string"))


def forms(vocabulary: DataFrame, times: int = 10) -> DataFrame:
    """word, form, n, n_near, form_n of a (word, n) table; see ``spelling_variants``."""
    n_words = vocabulary.count()
    near = _neighbours(vocabulary, n_words, False).union(_neighbours(vocabulary, n_words, True))
    # ties go to the smallest word in code-point order
    best = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("n")).alias("minus"), "near")).alias("best"))
    joined = vocabulary.join(best, "word", "left")
    counts = F.col("best.minus") <= -times * F.col("n")
    return joined.select("word", F.when(counts, F.col("best.near")).alias("form"), "n",
                         F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(counts, -F.col("best.minus")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by pointer doubling.

    A form is several times as frequent as its word, so the chains are as long
    as the logarithm of the largest count, and the rounds the logarithm of that.
    """
    up = written(formed.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if up.join(further, "root", "left_semi").isEmpty():
            return up
        up = written(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def spelling_variants(docs: DataFrame, times: int = 10) -> DataFrame:
    """The vocabulary of ``docs`` with each word's form and root.

    Words are lower-cased (A-Z) runs of letters of at least 7 code points that
    occur twice or more; one in 31 runs loses a letter first, as told by a hash
    of doc_id and run (null doc_id: an empty one). Two words are near if they
    differ by one inserted, deleted or replaced code point. Returns word, form
    (its most frequent near word, the smallest of several, if that occurs
    ``times`` as often; else null), root (the last of its form's form and so
    on, the word itself without a form), n, n_near and form_n. Null and empty
    texts have no words; repeated rows count each. No rows give no rows. Only
    doc_id and text are read.
    """
    vocabulary = written(word_counts(docs), "spelling-words")
    formed = written(forms(vocabulary, times), "spelling-forms")
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
