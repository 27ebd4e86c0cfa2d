"""Exact token counts of every prefix of a text by prefix dynamic programming.

A byte-pair vocabulary with word ends encodes each word for itself. Within a
word the encoding of a prefix is the encoding of a shorter prefix and one last
token, and exactly one choice of it is right: the one whose pair with the last
token before it would not have been merged across. So ``last`` and ``count`` of
all prefixes follow from those of shorter ones, without encoding anything. A
word that ends after i characters takes its last token from the vocabulary's
word-ending tokens. Over a whole text the counts of its words add up, which
answers budget and truncation questions from the stored counts.

Stretches with letters outside the plain ones go through the library's own
normalizer and pre-tokenizer, with offsets back to the text, and the words it
gives through the same program. Only special strings and the few characters of a
cut between two words are left to the library's encoder.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import short_batches
from .tokens import ChunkEncoder, byte_letters, tokenizer_path

MEMORY = 600_000
#: Words of more letters are counted from a list of their own states, which is not remembered.
LONG_WORD = 64
#: White space that no normal form, word or special string reaches across.
STRETCH = re.compile(r"[^\t-\r ]+")
COUNTED = "n_bytes long, n_tokens long, over_limit boolean, fits_chars long"


class PrefixCounter:
    """Token counts of texts and of their prefixes under one vocabulary with word ends."""

    WORD_END = "</w>"
    PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"

    def __init__(self, name: str):
        import regex

        path = name if os.path.sep in name else tokenizer_path(name)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocab = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: r for r, pair in enumerate(pairs)}
        self.made_of = {a + b: (a, b) for a, b in pairs}
        self.longest: dict[str, int] = {}  # letters of the longest token that ends with a letter (and the word)
        for token in self.vocab:
            word_end = token.endswith(self.WORD_END) and len(token) > len(self.WORD_END)
            letters = token[:-len(self.WORD_END)] if word_end else token
            end = letters[-1:] + (self.WORD_END if word_end else "")
            self.longest[end] = max(self.longest.get(end, 0), len(letters))
        self.letters = byte_letters()
        self.piece = regex.compile(self.PIECE)
        self.library = ChunkEncoder(name)
        tokenizer = self.library.tokenizer
        self.normalizer, self.pre_tokenizer = tokenizer.normalizer, tokenizer.pre_tokenizer
        specials = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile(f"({'|'.join(map(re.escape, specials))})") if specials else None
        self._parted: tuple[str, list] = ("", [])
        self._edges: tuple[dict, dict] = ({}, {})
        self._fits: dict[tuple[str, str], bool] = {}
        self._states: dict[str, tuple[str, int]] = {}
        self._chunks: dict[str, int] = {}

    def _edge(self, token: str, side: int) -> list[tuple[str, int, int]]:
        """The token's parts at one edge, from a letter up to itself: (part, merge that made it, merge that ends it)."""
        known = self._edges[side].get(token)
        if known is None:
            parts, until, part = [], len(self.rank), token
            while True:
                halves = self.made_of.get(part)
                made = self.rank[halves] if halves else -1
                parts.append((part, made, until))
                if not halves:
                    break
                part, until = halves[side], made
            known = self._edges[side][token] = parts[::-1]
        return known

    def fits(self, left: str, right: str) -> bool:
        """Whether the two tokens stay apart, i.e. no merge crosses them before both are whole."""
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) > MEMORY:
                self._fits.clear()
            known = self._fits[left, right] = self._apart(left, right)
        return known

    def _apart(self, left: str, right: str) -> bool:
        rank = self.rank
        for a, made_a, until_a in self._edge(left, 1):
            for b, made_b, until_b in self._edge(right, 0):
                r = rank.get((a, b))
                # equal ranks are merged from the left: the left token's own merge comes before the
                # crossing one, the crossing one before the right token's
                if r is not None and made_a <= r < until_a and made_b <= r <= until_b:
                    return False
        return True

    def _last(self, letters: str, n: int, ending: str, before) -> tuple[str, int]:
        """Last token and count of ``letters[:n]`` as a word's beginning, or as a whole word with its end.

        ``before`` gives those of each shorter beginning.
        """
        vocab = self.vocab
        for start in range(max(0, n - self.longest.get(letters[n - 1] + ending, 0)), n):
            token = letters[start:n] + ending
            if token in vocab:
                if not start:
                    return token, 1
                last, count = before(start)
                if self.fits(last, token):
                    return token, count + 1
        raise ValueError(f"no token ends {letters[:n]!r}")

    def word(self, text: str) -> int:
        """Tokens of one word."""
        return self._word(text if text.isascii() else "".join([self.letters[b] for b in text.encode()]))

    def _word(self, letters: str) -> int:
        if len(letters) > LONG_WORD:
            return LongWord(self, letters).count(len(letters))
        states = self._states
        if len(states) > MEMORY:
            states.clear()
        before = lambda start: states[letters[:start]]
        known = len(letters) - 1
        while known and letters[:known] not in states:
            known -= 1
        for i in range(known + 1, len(letters)):
            states[letters[:i]] = self._last(letters, i, "", before)
        return self._last(letters, len(letters), self.WORD_END, before)[1]

    def chunk(self, text: str) -> int:
        """Tokens of a lower-case stretch without white space."""
        known = self._chunks.get(text)
        if known is None:
            if text.isalpha():
                known = self.word(text)
            else:
                pieces = self.piece.findall(text)
                known = self.word(pieces[0]) if len(pieces) == 1 else sum(map(self.chunk, pieces))
            if len(self._chunks) > MEMORY:
                self._chunks.clear()
            if len(text) <= 64:
                self._chunks[text] = known
        return known

    def stretch(self, text: str) -> int:
        """Tokens of any stretch without white space of ``STRETCH``."""
        if self.library.chunks(text) is not None:
            return sum(map(self.chunk, text.lower().split()))
        known = self._chunks.get(text)
        if known is None:
            known = sum(tokens for _, tokens, _ in self.parts(text))
            if len(text) <= 64:
                self._chunks[text] = known
        return known

    def parts(self, text: str) -> list[tuple[int, int, str | None]]:
        """(first character, tokens, letters) of a stretch's words, as the library cuts it.

        A text cut within a part has the tokens of the parts before it and those
        of the part's own beginning. Words that a cut between them would change
        (joined by normal forms, or made of one character) are one part without
        letters, as is a special string with the word before it.
        """
        from tokenizers import PreTokenizedString

        if self._parted[0] == text:
            return self._parted[1]
        out: list[tuple[int, int, str | None]] = []
        at = 0
        for section in self.special.split(text) if self.special else [text]:
            if self.special and self.special.fullmatch(section):
                first, tokens, _ = out.pop() if out else (at, 0, None)
                out.append((first, tokens + 1, None))
            elif section:
                words, end, after = PreTokenizedString(section), 0, len(out)
                words.normalize(self.normalizer.normalize)
                self.pre_tokenizer.pre_tokenize(words)
                for letters, (lo, hi), _ in words.get_splits("original", "char"):
                    tokens = self._word(letters)
                    if len(out) > after and (lo < end or _may_join(section[lo])):
                        first, before, _ = out.pop()
                        out.append((first, before + tokens, None))
                    else:
                        out.append((at + lo, tokens, letters))
                    end = hi
            at += len(section)
        self._parted = text, out
        return out

    def _beginning(self, text: str, letters: str | None):
        """A function that gives the tokens of ``text[:n]``, for the text of one part."""
        if letters is not None and len(text) > LONG_WORD:
            own = ["".join([self.letters[b] for b in self.normalizer.normalize_str(c).encode()]) for c in text]
            ends = [0, *accumulate(map(len, own))]
            # characters after the word (white space that STRETCH does not cut at) have no letters
            if "".join(own) == letters:
                word = LongWord(self, letters)
                return lambda n: word.count(ends[n])
        return lambda n: len(self.library.encode([text[:n]])[0]) // 4

    def count_within(self, text: str, chars: int) -> int:
        """Tokens of ``text[:chars]`` of one stretch."""
        if len(text) <= LONG_WORD and self.library.chunks(text) is not None:
            return self.chunk(text[:chars].lower())
        parts = self.parts(text)
        k = bisect_right([first for first, _, _ in parts], chars) - 1
        if k < 0:
            return 0
        first, _, letters = parts[k]
        stop = parts[k + 1][0] if k + 1 < len(parts) else len(text)
        return sum(tokens for _, tokens, _ in parts[:k]) + self._beginning(text[first:stop], letters)(chars - first)

    def fit_within(self, text: str, budget: int) -> int:
        """Characters of one stretch's longest beginning of at most ``budget`` tokens; the whole has more."""
        if len(text) <= LONG_WORD and self.library.chunks(text) is not None:
            # a longer part of a word may have fewer tokens than a shorter one
            return next((n for n in range(len(text) - 1, 0, -1) if self.chunk(text[:n].lower()) <= budget), 0)
        parts = self.parts(text)
        sums = list(accumulate(tokens for _, tokens, _ in parts))
        k = bisect_right(sums, budget)
        left = budget - (sums[k - 1] if k else 0)
        first, _, letters = parts[k]
        stop = parts[k + 1][0] if k + 1 < len(parts) else len(text)
        count = self._beginning(text[first:stop], letters)
        return next((first + n for n in range(stop - first - 1, 0, -1) if count(n) <= left), first)

    def count(self, text: str) -> int:
        """Tokens of a whole text, as the library gives them."""
        return self.table(text).total

    def table(self, text: str) -> PrefixTable:
        return PrefixTable(self, text)


def _may_join(c: str) -> bool:
    """Whether a normal form may join the character with those before it: marks, and vowels and finals of some scripts."""
    return unicodedata.category(c) in ("Mn", "Mc", "Me", "Cn") or "\u1160" <= c <= "\u11ff" or "\U00016d63" <= c <= "\U00016d6a"


class LongWord:
    """Last tokens and counts of all beginnings of one word's letters."""

    def __init__(self, counter: PrefixCounter, letters: str):
        self.counter, self.letters = counter, letters
        self.states = [("", 0)]
        for n in range(1, len(letters)):
            self.states.append(counter._last(letters, n, "", self.states.__getitem__))

    def count(self, n: int) -> int:
        """Tokens of the first ``n`` letters as a word."""
        return self.counter._last(self.letters, n, self.counter.WORD_END, self.states.__getitem__)[1] if n else 0


class PrefixTable:
    """Stored counts of one text: after each of its white-space-free stretches, and within them on demand."""

    def __init__(self, counter: PrefixCounter, text: str):
        self.counter, self.text = counter, text
        plain = counter.library.chunks(text)
        self.stretch = STRETCH if plain is None else re.compile(r"\S+")
        self.chunks = STRETCH.findall(text) if plain is None else plain
        self.counts = list(accumulate(map(counter.stretch if plain is None else counter.chunk, self.chunks)))
        self.total = self.counts[-1] if self.counts else 0

    def _spans(self, first: int, n: int) -> list[tuple[int, int]]:
        return [m.span() for m in islice(self.stretch.finditer(self.text), first, first + n)]

    def count(self, chars: int) -> int:
        """Tokens of ``text[:chars]``."""
        spans = self._spans(0, len(self.chunks))
        k = bisect_right([end for _, end in spans], chars)  # whole stretches before the cut
        whole = self.counts[k - 1] if k else 0
        if k < len(spans) and spans[k][0] < chars:
            whole += self.counter.count_within(self.chunks[k], chars - spans[k][0])
        return whole

    def fits(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        if self.total <= budget:
            return len(self.text)
        k = bisect_right(self.counts, budget)
        before = self.counts[k - 1] if k else 0
        return self._spans(k, 1)[0][0] + self.counter.fit_within(self.chunks[k], budget - before)


_counters: dict[str, PrefixCounter] = {}


def counter(name: str) -> PrefixCounter:
    """This process's counter of a vocabulary; kept between the tasks of one worker."""
    if name not in _counters:
        _counters[name] = PrefixCounter(name)
    return _counters[name]


def token_counts(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and fits_chars of every row.

    n_tokens is that of the whole text; fits_chars the code points of its
    longest prefix of at most ``limit`` tokens. Null and empty texts have 0 of
    each. Repeated rows get equal results; other columns are not read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(tokenizer)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                table = counts.table(text or "")
                rows.append((len((text or "").encode()), table.total, table.total > limit, table.fits(limit)))
            cols = list(zip(*rows)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fits_chars"])

    short_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(scan, f"doc_id long, {COUNTED}")


def prefix_tables(docs: DataFrame, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """doc_id, ends and counts: tokens (counts[i]) of the prefix of ends[i] characters, one per stretch of text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(tokenizer)
        for batch in batches:
            ends, tokens = [], []
            for text in batch.column("text").to_pylist():
                table = counts.table(text or "")
                ends.append([end for _, end in table._spans(0, len(table.chunks))]), tokens.append(table.counts)
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ends, lists), pa.array(tokens, lists)],
                                             names=["doc_id", "ends", "counts"])

    short_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, ends array<long>, counts array<long>")
