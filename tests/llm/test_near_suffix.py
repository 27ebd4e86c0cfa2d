"""LSH forest and suffix dedup against brute force, with copies in bulk and odd rows."""

import collections
import hashlib
import random
import re

import pytest
from flowlake.llm import lsh_forest, suffix_dedup
from flowlake.llm.components import connected_components
from llm_fixtures import no_docs, odd_docs  # noqa: F401


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(len(words) - n + 1, 1)))


def components(rows, n, percent=80):
    """Smallest id reachable for each (id, text)."""
    sets = [shingles(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[root(i)] = min(low.get(root(i), doc), doc)
    return [low.get(root(i)) if sets[i] else doc for i, (doc, _) in enumerate(rows)], [len(s) for s in sets]


def made_docs(seed=1):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 7))) for _ in range(400)]
    text = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    rows, base = [], text(150)
    for _ in range(40):
        rows.append(text(rnd.randint(1, 200)))
    for edits in [0] * 15 + [1, 2, 3, 5, 8, 13, 20, 30] * 5:  # copies and near copies of one text
        copy = list(base)
        for _ in range(edits):
            copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
        rows.append(copy)
    for _ in range(30):  # a chain: each a few edits from the one before
        base = list(base)
        for _ in range(4):
            base[rnd.randrange(len(base))] = rnd.choice(vocabulary)
        rows.append(base)
    rnd.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("words", [2, 5])
def test_components_equal_brute_force(spark, words):
    rows = made_docs()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.component_id, r.n_shingles)
           for r in lsh_forest.near_duplicate_groups(docs, words=words).collect()}
    want, sizes = components(rows, words)
    assert [got[i] for i, _ in rows] == list(zip(want, sizes))


def test_components_of_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want, sizes = components(rows, 2)
    got = lsh_forest.near_duplicate_groups(odd_docs).collect()
    assert sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id) for r in got))) == sorted(
        map(str, ((doc, n, c) for (doc, _), n, c in zip(rows, sizes, want))))
    assert lsh_forest.near_duplicate_groups(no_docs).count() == 0


def test_one_row_of_each_group_stays(odd_docs, no_docs):
    kept = lsh_forest.keep_one_of_each_group(odd_docs, words=5)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    by_text = collections.Counter(r.text for r in rows)
    assert by_text["same row " * 60] == 1 and by_text["word"] == 1
    assert sum(r.doc_id in (1, 2, 3) for r in rows) == 1 and {1} == {r.doc_id for r in rows} & {1, 2, 3}
    assert by_text[None] == 2 and by_text[""] == 1 and by_text[" \t\n "] == 1
    assert lsh_forest.keep_one_of_each_group(no_docs).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 90)],
                                   [(5, 3), (3, 9), (8, 7), (7, 8), (100, 200), (200, 300), (300, 100)]])
def test_connected_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    up = {x: x for e in edges for x in e}
    for _ in up:
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    groups = collections.defaultdict(set)
    for x, r in got.items():
        groups[r].add(up[x])
    assert set(got) == set(up) and all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(up.values()))


def cut_truth(rows, size):
    raws = [(t or "").encode() for t in rows]
    seen = collections.Counter(raw[p:p + size] for raw in raws for p in range(len(raw) - size + 1))
    out = []
    for raw in raws:
        gone = [False] * len(raw)
        for p in range(len(raw) - size + 1):
            if seen[raw[p:p + size]] > 1:
                gone[p:p + size] = [True] * size
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_removed_bytes_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    letters = lambda n: "".join(rnd.choices("abcdé ", k=n))
    shared = [letters(n) for n in (20, 39, 40, 41, 60, 120, 300)]
    texts = [letters(rnd.randint(0, 80)) + rnd.choice(shared) + letters(rnd.randint(0, 9)) + rnd.choice(shared)
             for _ in range(60)] + ["ab" * 100, "a" * 90, shared[6], shared[6], "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, threshold=40, digit=12).collect()}
    for i, (n, gone, spans, sha, kept) in enumerate(cut_truth(texts, 40)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, gone, spans, sha), texts[i]
        assert bytes(r.kept) == kept if gone else r.kept is None


def passage_truth(rows, size):
    texts = [re.split("[ \\t-\\r]+", (t or "").strip(" \t\n\x0b\x0c\r")) if (t or "").strip(" \t\n\x0b\x0c\r") else [] for t in rows]
    windows = collections.Counter(tuple(w[p:p + size]) for w in texts for p in range(len(w) - size + 1))
    out = []
    for w in texts:
        covered = set()
        for p in range(len(w) - size + 1):
            if windows[tuple(w[p:p + size])] > 1:
                covered.update(range(p, p + size))
        out.append(len(covered))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_words_of_repeated_passages_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    words = lambda n: [rnd.choice(["a", "bé", "cc", "ddd"]) for _ in range(n)]
    shared = [words(n) for n in (5, 11, 12, 13, 30, 90)]
    texts = [rnd.choice([" ", "\n", "\t "]).join(words(rnd.randint(0, 30)) + rnd.choice(shared) + words(rnd.randint(0, 3))
                                                 + rnd.choice(shared)) for _ in range(50)]
    texts += ["x " * 60, " ".join(shared[5]), "  " + " ".join(shared[5]), "", None, " \n", "one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.n_passage_words
           for r in suffix_dedup.remove_repeats(docs, threshold=4000, passage=12).collect()}
    assert [got[i] for i in range(len(texts))] == passage_truth(texts, 12)


def test_passages_of_51_words_are_told_whatever_their_bytes(spark):
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    passages = {n: " ".join(word(5) for _ in range(n)) for n in (50, 51, 52, 70)}
    rows = [(10 * n + i, " ".join(word(6) for _ in range(40)) + f" {p} " + " ".join(word(6) for _ in range(40)))
            for n, p in passages.items() for i in range(2)]
    rows += [(i, " ".join(word(6) for _ in range(150))) for i in range(8)]  # clean
    got = {r.doc_id: (r.n_removed, r.n_passage_words) for r in suffix_dedup.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string"), passage=51).collect()}
    assert all(got[i] == (0, 0) for i in range(8))
    for n in passages:
        assert [got[10 * n + i][1] for i in range(2)] == [n if n > 50 else 0] * 2
    assert got[510][0] == 0 and got[700][0] > 0


def test_equal_hashes_of_long_words_need_equal_words(spark):
    """The Thue-Morse word and its complement: alike for any polynomial hash modulo 2^64."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    docs = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in lsh_forest.near_duplicate_groups(docs).collect()} == {1: 1, 2: 2, 3: 1}


def test_suffix_dedup_of_odd_rows(odd_docs, no_docs):
    small = odd_docs.filter("text is null or length(text) < 10000")
    rows = small.collect()
    want = sorted((str(r.doc_id), *t[:4]) for r, t in zip(rows, cut_truth([r.text for r in rows], 400)))
    got = suffix_dedup.remove_repeats(small).drop("kept").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want
    words = sorted(zip((str(r.doc_id) for r in rows), passage_truth([r.text for r in rows], 51)))
    assert sorted((str(r.doc_id), r.n_passage_words) for r in suffix_dedup.remove_repeats(small, passage=51).collect()) == words
    long = suffix_dedup.remove_repeats(odd_docs).filter("doc_id = 10").collect()[0]
    assert long.n_removed == long.n_bytes and long.n_spans == 1  # periodic: every window stands elsewhere
    out = suffix_dedup.without_repeats(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert out.filter("text is null").count() == 2
    assert suffix_dedup.remove_repeats(no_docs, passage=51).count() == 0 and suffix_dedup.without_repeats(no_docs).count() == 0


def test_windows_at_the_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    rnd = random.Random(9)
    text = "".join(rnd.choices("abcdefgh", k=900))
    other = "".join(rnd.choices("abcdefgh", k=50)) + text[100:700]
    buf = text.encode() + other.encode()
    import numpy as np
    groups = list(suffix_dedup.pieces(np.array([0, len(text), len(buf)]), 40))
    covered = {(row, p) for g in groups for row, first, end in g for p in range(first, end - 39)}
    assert covered == {(0, p) for p in range(861)} | {(1, p) for p in range(len(other) - 39)}


def test_links_within_a_dense_family_are_found(spark):
    """Thousands of classes at similarity 0.75 to each other; planted pairs of them at 0.82."""
    family, n, planted = [f"t{i}" for i in range(86)], 3000, 200
    own = lambda i, k: [f"d{i}x{j}" for j in range(k)]
    rows = [(i, family + own(i, 14)) for i in range(n)]
    for i in range(planted):  # all but 10 words of a member
        rows.append((n + i, rows[i][1][:-10] + own(n + i, 10)))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicate_groups(docs, words=1).collect()}
    assert got == {i: i - n if i >= n else i for i, _ in rows}


def test_pipeline_cuts_repeated_passages_of_51_short_words(spark):
    import corpus_pipeline

    rnd = random.Random(8)
    word = lambda n: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    passage = " ".join(word(4 if i % 2 else 3) for i in range(51))
    assert 220 <= len(passage) <= 230
    rows = [(i, " ".join(word(7) for _ in range(60)) + f" {i}{passage}{i} " + " ".join(word(7) for _ in range(60)), "en", "s")
            for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.text for r in corpus_pipeline.suffix_dedup(spark, docs, "").collect()}
    assert not any(passage in text for text in kept.values())
