"""License scan by an exact set-similarity join, in DataFrame operations only.

Text blocks and license templates are sets of tokens. A block is a line and as
many of the words after it as the longest template has, so that a notice is
found however it is wrapped; it ends at a line without a word. A block matches a
template when it holds at least a given share of the template's tokens. All
tokens are ordered by how often they occur in the corpus, rarest first. A block
that meets the threshold must hold one of the template's first few tokens in
that order (prefix filter), have enough tokens at all (length filter), and have
enough left after the first common one (positional filter). Only blocks that
pass all three are compared token by token, so every match is found and few
others are looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_keys

NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: The same in texts that are not lower-cased yet.
CASED_NO_WORD = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
CASED_WORD = CASED_NO_WORD.replace("[", "[^", 1)

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Usual notices of well-known licenses, by label.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License"),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


@dataclass(frozen=True)
class Template:
    """A template's label, its tokens from the rarest to the most frequent, and how many of them a match needs."""

    label: str
    tokens: tuple[str, ...]
    need: int

    @property
    def prefix(self) -> tuple[str, ...]:
        """A block without any of these lacks too many tokens to match."""
        return self.tokens[:len(self.tokens) - self.need + 1]


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all else unchanged.

    Spark's lower also turns U+212A and U+0130 into ASCII letters; texts that
    have these go letter by letter.
    """
    odd = text.contains("K") | text.contains("İ")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(odd, F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def token_set(text: str) -> set[str]:
    """Tokens of a template, which is ASCII."""
    return set(words_in(text))


def words_in(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def longest(templates: list[tuple[str, str]]) -> int:
    """Words of the longest template: no wrapped notice has more of them after its first line."""
    return max(len(words_in(text)) for _, text in templates)


def blocks(docs: DataFrame, vocabulary: list[str], ahead: int) -> DataFrame:
    """k1, k2 and tokens of every line's block that has any: its distinct tokens among the templates' ones.

    ahead: words that a block takes from the lines after its own, up to a line
    without a word. Tokens of no template can never be common ones, so a
    block's size counts those of the vocabulary.
    """
    key = row_keys(F.col("doc_id"), F.col("text"))
    lines = F.split(ascii_lower(F.col("text")), "\n")
    rows = docs.filter("text is not null")

    def known(words):
        return F.filter(words, lambda t: t.isin(vocabulary))

    if not ahead:
        found = rows.select(*key, F.explode(lines).alias("line")).select(
            "k1", "k2", F.array_distinct(known(F.split("line", NO_WORD))).alias("tokens"))
        return found.filter(F.size("tokens") > 0)
    words = F.transform(lines, lambda line: F.filter(F.split(line, NO_WORD), lambda w: w != ""))
    cut = F.transform(words, lambda ws: F.struct(known(ws).alias("own"), F.slice(ws, 1, ahead).alias("first")))
    none = F.array().cast("array<string>")

    def take(so_far, line):
        ends = so_far.ended | (F.size(line.first) == 0)
        more = F.concat(so_far.words, line.first)
        return F.struct(F.when(ends, so_far.words).otherwise(more).alias("words"),
                        (ends | (F.size(more) >= ahead)).alias("ended"))

    def block(line, i):
        # each line before the end has a word, so ``ahead`` lines are enough
        after = F.aggregate(F.slice("lines", i + 2, ahead), F.struct(none.alias("words"), F.lit(False).alias("ended")), take)
        return F.array_distinct(F.concat(line.own, known(F.slice(after.words, 1, ahead))))

    found = rows.select(*key, cut.alias("lines")).select("k1", "k2", F.explode(F.transform("lines", block)).alias("tokens"))
    return found.filter(F.size("tokens") > 0)


def ordered_templates(docs: DataFrame, templates: list[tuple[str, str]],
                      percent: int) -> tuple[list[Template], list[str]]:
    """Templates in corpus order, and that order: template tokens by the number of blocks that hold them.

    Counts come from all lines, ties go by token; one row for each template token comes back.
    """
    sets = [(label, token_set(text)) for label, text in templates]
    vocabulary = sorted(set().union(*(s for _, s in sets)))
    counts = (blocks(docs, vocabulary, 0).select(F.explode("tokens").alias("t")).groupBy("t")
              .agg(F.count(F.lit(1)).alias("n")).collect())
    often = {r.t: r.n for r in counts}
    order = sorted(vocabulary, key=lambda t: (often.get(t, 0), t))
    return [Template(label, tuple(sorted(s, key=order.index)), -(-len(s) * percent // 100))
            for label, s in sets if s], order


def matching_blocks(docs: DataFrame, templates: list[Template], order: list[str], ahead: int) -> DataFrame:
    """(k1, k2, label, score) for every block and template it matches; score: share of the template's tokens."""
    # at most as many rows as the given templates have tokens
    prefixes = docs.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("token"), F.lit(place).alias("place"), F.lit(len(x.tokens)).alias("size"),
                 F.lit(x.need).alias("need"), F.lit(x.label).alias("label"),
                 F.array(*map(F.lit, x.tokens)).alias("of_template"))
        for x in templates for place, t in enumerate(x.prefix)])))
    starts = sorted({t for x in templates for t in x.prefix})
    least = min(x.need for x in templates)
    probed = (blocks(docs, order, ahead).filter(F.size("tokens") >= least)
              .filter(F.arrays_overlap("tokens", F.array(*map(F.lit, starts))))
              # an intersection keeps the order of its first part
              .select("k1", "k2", F.array_intersect(F.array(*map(F.lit, order)), F.col("tokens")).alias("tokens"))
              .select("k1", "k2", "tokens", F.posexplode("tokens").alias("at", "token")))
    left = F.least(F.col("size") - F.col("place"), F.size("tokens") - F.col("at"))
    candidates = (probed.join(F.broadcast(prefixes), "token")
                  .filter((F.size("tokens") >= F.col("need")) & (left >= F.col("need"))))
    common = F.size(F.array_intersect("tokens", "of_template"))
    return (candidates.withColumn("common", common).filter(F.col("common") >= F.col("need"))
            .select("k1", "k2", "label", (F.col("common") / F.col("size")).alias("score")))


def _any_like(column: str, pattern: str) -> Column:
    return F.exists(column, lambda x: x.rlike(pattern))


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, percent: int = 90) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row.

    Words are ASCII lower case. n_base counts the places where a phrase's words
    stand consecutively, also over line ends; first_word and last_word are the
    smallest and largest word numbers at which one starts, null without any.
    labels adds those of the templates of which some block (see ``blocks``)
    holds at least ``percent`` / 100 of the tokens; score is the largest share among these, 0
    without a match. Null and empty texts have no words. Repeated rows get
    equal results; only doc_id and text are read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    templates = TEMPLATES if templates is None else templates
    ordered, order = ordered_templates(rows, templates, percent)
    found = (matching_blocks(rows, ordered, order, longest(templates)).groupBy("k1", "k2")
             .agg(F.collect_set("label").alias("more"), F.max("score").alias("score")))  # a set of given labels
    text = F.coalesce("text", F.lit(""))
    some = {label: phrase.replace(" ", CASED_NO_WORD) for phrase, label in PHRASES.items()}
    edge_before, edge_after = f"(?<!{CASED_WORD[:-1]})", f"(?!{CASED_WORD[:-1]})"
    pattern = f"(?i){edge_before}(?:{'|'.join(some.values())}){edge_after}"
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    words = lambda c: F.regexp_count(c, F.lit(CASED_WORD)).cast("long")
    base = rows.select(*row_keys(F.col("doc_id"), F.col("text")), "doc_id", words(text).alias("n_words"),
                       F.when(text.rlike(pattern), text).alias("text"))
    base = base.withColumn("hits", F.when(F.col("text").isNotNull(), hits).otherwise(F.array().cast("array<string>")))
    between = base.withColumn("rest", F.when(F.size("hits") > 0, F.split("text", pattern)))
    last = F.try_element_at("hits", F.lit(-1))
    base = between.select(
        "k1", "k2", "doc_id", "n_words", F.size("hits").cast("long").alias("n_base"),
        words(F.col("rest")[0]).alias("first_word"),
        (F.col("n_words") - words(F.try_element_at("rest", F.lit(-1))) - words(last)).alias("last_word"),
        F.array_compact(F.array(*[
            F.when(_any_like("hits", f"(?i)^{p}$"), F.lit(label)) for label, p in sorted(some.items())])).alias("base"))
    joined = base.join(found, ["k1", "k2"], "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                         F.array_join(F.array_sort("base"), ",").alias("base_labels"),
                         F.array_join(labels, ",").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
