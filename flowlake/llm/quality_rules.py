"""Quality rules by distribution divergence, in DataFrame operations only.

A document's character-class histogram and its common-word histogram are
compared with those of each language's whole corpus by Jensen-Shannon distance
(base 2, 0 to 1). The languages are the values of ``lang``, and a language's
common words are the most frequent ones of its documents. A document that is
far from every language is no running text. Short documents have noisy
histograms, so a histogram only counts against a document from a minimum length
on; a language is a reference from a minimum length on as well.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]+"

@dataclass(frozen=True)
class Divergence:
    """Farthest distances from a language's histograms, and the lengths from which they count.

    Even running text lies off its language's histogram by about one over the
    square root of its length; ``noise`` times that is added to both limits.
    ``common`` is the number of common words of a language, and a value of
    ``lang`` with fewer than ``min_reference`` words in all is no reference.
    """

    max_chars: float = 0.2
    max_words: float = 0.2
    noise: float = 1.2
    min_chars: int = 200
    min_words: int = 50
    common: int = 20
    min_reference: int = 1000


@dataclass(frozen=True)
class Reference:
    """A language's shares of the character classes, its common words, and their shares with that of all others."""

    chars: list[float]
    common: list[str]
    words: list[float]


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once for each row."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, characters: str) -> Column:
    return F.regexp_replace(text, characters, "")


#: Classes of characters, each counted in what the classes before it left.
CLASSES = ["[a-z]+", SPACE, "[A-Z]+", "[^\\x00-\\x7F\\P{L}]+", "[.,;:!?'\"()-]+", "[0-9]+"]


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def character_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with chars (characters by class) and total_chars."""
    names = [f"left{k}" for k in range(len(CLASSES) + 1)]
    out = docs.withColumn(names[0], _text())
    for characters, before, after in zip(CLASSES, names, names[1:]):
        out = out.withColumn(after, _without(F.col(before), characters))
    sizes = [F.length(c) for c in names]
    chars = [a - b for a, b in zip(sizes, sizes[1:])] + [sizes[-1]]
    return out.withColumns({"chars": F.array(*chars), "total_chars": sizes[0]}).drop(*names)


def histograms(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``docs`` with words, chars (characters by class), common (counts of the vocabulary) and both totals."""
    out = character_counts(docs.withColumn("words", F.array_remove(F.split(_text(), SPACE), "")))
    common = F.filter("words", lambda w: w.isin(vocabulary))
    listed = F.array(*map(F.lit, vocabulary)) if vocabulary else F.array().cast("array<string>")
    counts = _bound(common, lambda c: F.transform(listed, lambda w: F.size(c) - F.size(F.array_remove(c, w))))
    return out.withColumns({"common": counts, "total_words": F.size("words")})


def language_references(docs: DataFrame, rules: Divergence) -> dict[str, Reference]:
    """The reference of every value of ``lang``, over whole texts of all its documents.

    Words are counted by (lang, word) with a map-side step; each task then keeps
    a language's most frequent words only. ``common`` rows for each language
    come back, and one with its characters.
    """
    labelled = docs.filter(F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), "text")
    counts = (labelled.select("lang", F.explode(F.split(_text(), SPACE)).alias("word")).where("word <> ''")
              .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n_words")).where(F.col("n_words") >= rules.min_reference)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counts.withColumn("place", place).where(F.col("place") <= rules.common)
    words: dict[str, list] = {}
    for r in top.join(totals, "lang").orderBy("lang", "place").collect():
        words.setdefault(r.lang, []).append(r)
    sums = [F.sum(F.col("chars")[k]).alias(f"c{k}") for k in range(len(CLASSES) + 1)]
    by_class = character_counts(labelled).groupBy("lang").agg(*sums).where(F.col("lang").isin(list(words)))
    out = {}
    for lang, *chars in sorted(by_class.collect()):
        own, n_words = [r.n for r in words[lang]], words[lang][0].n_words
        out[lang] = Reference([c / sum(chars) for c in chars], [r.word for r in words[lang]],
                              [n / n_words for n in [*own, n_words - sum(own)]])
    return out


def jensen_shannon(counts: Column, total: Column, reference: Column) -> Column:
    """Distance of counts / total from a reference distribution."""

    def term(n: Column, q: Column) -> Column:
        p = n / total
        m = (p + q) / 2
        return (F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)) / 2

    terms = F.zip_with(counts, reference, term)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))


def _repeated_words(words: Column) -> Column:
    """Places of words in 3-word windows that occur at least twice."""
    n = F.size(words) - 2
    pairs = F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.xxhash64(a, b))
    windows = F.zip_with(pairs, F.slice(words, 3, n), lambda ab, c: F.xxhash64(ab, c))

    def neighbours(s: Column, body) -> Column:
        return F.filter(F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), body),
                        lambda x: x.isNotNull())

    def few(h: Column, again: Column) -> Column:
        return F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(again, x), i)), lambda i: i.isNotNull())

    def many(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return F.flatten(_bound(placed, lambda s: neighbours(
            s, lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"])))))

    def covered(at: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))

    def count(h: Column) -> Column:
        twice = F.sort_array(h)
        again = _bound(twice, lambda s: F.array_distinct(neighbours(s, lambda a, b: F.when(a == b, a))))
        at = _bound(again, lambda d: F.when(F.size(d) <= 50, few(h, d)).otherwise(many(h)))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered(at)).otherwise(0)

    return F.when(F.size(words) > 3, _bound(windows, count)).otherwise(0)


def _near(references: dict[str, Reference], vocabulary: list[str], rules: Divergence) -> Column:
    """Whether some language has both histograms near enough; every document is, without any reference."""
    if not references:
        return F.lit(True)
    total_chars, n_words = F.col("total_chars"), F.col("total_words")
    some_chars, some_words = F.greatest(total_chars, F.lit(1)), F.greatest(n_words, F.lit(1))  # divisors
    limit_chars = rules.max_chars + rules.noise / F.sqrt(some_chars)
    limit_words = rules.max_words + rules.noise / F.sqrt(some_words)
    place = {w: k for k, w in enumerate(vocabulary)}
    known = F.array(*[F.struct(
        F.array(*map(F.lit, r.chars)).alias("chars"), F.array(*[F.lit(place[w]) for w in r.common]).alias("at"),
        F.array(*map(F.lit, r.words)).alias("words")) for r in references.values()])

    def with_rest(own: Column) -> Column:
        return F.concat(own, F.array(n_words - F.aggregate(own, F.lit(0), lambda a, x: a + x)))

    def near(r: Column) -> Column:
        own = F.transform(r["at"], lambda k: F.col("common")[k])
        return (((total_chars < rules.min_chars)
                 | (jensen_shannon(F.col("chars"), some_chars, r["chars"]) <= limit_chars))
                & ((n_words < rules.min_words)
                   | (jensen_shannon(_bound(own, with_rest), some_words, r["words"]) <= limit_words)))

    return F.exists(known, near)


def quality(docs: DataFrame, rules: Divergence = Divergence()) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    base_failed: fewer than 50 words, or more than half of them in repeated
    3-word windows (windows are compared by 64-bit hashes). kept: not
    base_failed, and some language has both histograms near enough; one that
    is too short to be judged counts as near. Null and empty texts have no
    words and fail. Without any reference (an empty table, no lang, no
    language with enough words) nothing is far. Repeated rows get equal results; only
    doc_id, text and lang are read, and lang only for the references.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
                       F.col("lang").alias("lang"))
    references = language_references(rows, rules)
    vocabulary = sorted({w for r in references.values() for w in r.common})
    text = _text()
    line_has_word = lambda line: line.rlike("[^\\x20\\x09-\\x0D]")
    lines = F.filter(F.split(text, "\n"), line_has_word)
    total_chars, n_words = F.col("total_chars"), F.col("total_words")
    found = histograms(rows.drop("lang"), vocabulary).select(
        "doc_id", n_words.cast("long").alias("n_words"),
        F.length(_without(text, SPACE)).cast("long").alias("word_chars"),
        (total_chars - F.length(_without(text, "[#*$%&|<>]+"))).cast("long").alias("n_symbols"),
        _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        _near(references, vocabulary, rules).alias("near"))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & F.col("near")).alias("kept"))
