"""Spelling variants against brute force over all pairs of words."""

import collections
import random
import re
import zlib

import pytest
from flowlake.llm import spelling
from llm_fixtures import no_docs, odd_docs  # noqa: F401


def counted(rows):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 2}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_force(n):
    form, near = {}, {}
    words = sorted(n)
    for w in words:
        near[w] = [v for v in words if one_edit(w, v)]
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def variants(seed, bases=25, per=14):
    rnd = random.Random(seed)
    letters = "abcdéÿ"
    out = {}
    for _ in range(bases):
        base = "".join(rnd.choices(letters, k=rnd.randint(7, 14)))
        out[base] = rnd.choice([2, 40, 500])
        for _ in range(per):
            w, at = rnd.choice(list(out)), rnd.randrange(7)
            w = rnd.choice([w[:at] + w[at + 1:], w[:at] + rnd.choice(letters) + w[at:], w[:at] + rnd.choice(letters) + w[at + 1:]])
            out.setdefault(w, rnd.choice([2, 3, 4, 20, 45]))
    return {w: k for w, k in out.items() if len(w) >= 7}


@pytest.mark.parametrize("seed, segment", [(1, 20_000), (2, 10), (3, 3), (4, 1)])
def test_forms_equal_brute_force(spark, monkeypatch, seed, segment):
    """Segments of any size; one letter's words spread over many of them."""
    monkeypatch.setattr(spelling, "SEGMENT", segment)
    monkeypatch.setattr(spelling, "FEW", 1)
    n = variants(seed) | {"prefixed" + w: k for w, k in variants(seed + 50, 3).items()}
    vocabulary = spelling.written(spark.createDataFrame(list(n.items()), "word string, n long"), "test-words")
    formed = spelling.written(spelling.forms(vocabulary), "test-forms")
    up = {r.word: r.root for r in spelling.roots(formed).collect()}
    got = sorted(((r.word, r.form, up.get(r.word, r.word), r.n, r.n_near, r.form_n) for r in formed.collect()), key=str)
    want = brute_force(n)
    assert got == sorted(want, key=str)
    assert sum(w[1] is not None for w in want) > 20


def test_long_words(spark):
    """Words longer than what is looked up at once, with edits anywhere in them."""
    rnd = random.Random(3)
    base = "".join(rnd.choices("ab", k=150))
    n = {base: 100, "x" * 5000: 50, "x" * 5001: 5, "x" * 4999: 5, "x" * 4998: 500}
    for at in (0, 1, 31, 32, 33, 63, 64, 65, 74, 75, 76, 120, 149):
        n[base[:at] + base[at + 1:]] = 3
        n[base[:at] + "ÿ" + base[at + 1:]] = 4
        n[base[:at] + "é" + base[at:]] = 5
    vocabulary = spelling.written(spark.createDataFrame(list(n.items()), "word string, n long"), "test-words")
    got = {r.word: (r.form, r.n_near) for r in spelling.forms(vocabulary).collect()}
    assert got == {w: (form, near) for w, form, _, _, near, _ in brute_force(n)}


def test_counts_of_long_texts_cut_at_runs(monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 5)
    text = "Abc defghijkl,éÉmno 123 pqrstuvwxyz Abc\n" * 3 + "x" * 50
    assert spelling.run_counts(text) == collections.Counter(
        r.lower() if r.isascii() else r for r in re.findall("[A-Za-zÀ-ÿ]+", text))


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = sorted(map(tuple, spelling.spelling_variants(odd_docs).collect()))
    assert [g[0] for g in got] and got == sorted(brute_force(counted(rows)))
    assert spelling.spelling_variants(no_docs).count() == 0


def test_registered_query_over_whole_table(spark):
    from conftest import SF001
    from flowlake.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    n = counted(rows)
    got = {r.word: tuple(r) for r in QUERIES["op12_spelling_variants"](spark, SF001).collect()}
    assert {w: g[3] for w, g in got.items()} == n
    rnd = random.Random(1)
    words = sorted(n)
    for w in [*rnd.sample(words, min(200, len(words))), *[w for w, g in got.items() if g[1]][:100]]:
        near = [v for v in words if abs(len(v) - len(w)) <= 1 and one_edit(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= 10 * n[w] else None
        assert got[w][1] == form and got[w][4:] == (len(near), n[form] if form else None)
        assert got[w][2] == (got[form][2] if form else w)
