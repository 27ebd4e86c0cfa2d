"""Fill-in-the-middle against a plain version of its rule, and exact round trips."""

import hashlib
import random

import numpy as np
import pytest
from flowlake.llm import fill_in_middle as fim
from llm_fixtures import no_docs, odd_docs  # noqa: F401


def plain_version(doc_id, text):
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts(seed):
    rnd = random.Random(seed)
    letters = ["a", "é", "語", "😀", "<", ">", "P", "S", "M", "<P", "S>", "\n"]
    return ["".join(rnd.choices(letters, k=rnd.choice([0, 1, 2, 3, 10, 60]))) for _ in range(400)]


@pytest.mark.parametrize("group", [7, 64, 1 << 21])
def test_outputs_equal_the_plain_version(spark, monkeypatch, group):
    rows = list(enumerate(texts(group)))
    monkeypatch.setattr(fim, "GROUP", group)  # windows cut texts and pieces anywhere
    raws = [t.encode() for _, t in rows]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
    got = fim.transform(np.frombuffer(b"".join(raws), np.uint8), offsets, [i for i, _ in rows], 1, 10, 20)
    forms = set()
    for i, text in rows:
        n, form, prefix, middle, output = plain_version(i, text)
        assert bytes(got["out"][got["ends"][i]:got["ends"][i + 1]]).decode() == output
        assert (got["n"][i], fim.FORMS[got["form"][i]]) == (n, form)
        assert form == "plain" or (got["prefix_chars"][i], got["middle_chars"][i]) == (prefix, middle)
        forms.add(form)
    assert forms == {"plain", "psm", "spm"}
    back, ends = fim.restore(got["out"], got["ends"], got["form"])
    assert bytes(back) == b"".join(raws) and ends.tolist() == offsets.tolist()


def test_missing_marks_are_told():
    out = np.frombuffer(b"<P>ab<S>cd", np.uint8)
    with pytest.raises(ValueError):
        fim.restore(out, np.array([0, len(out)]), np.array([fim.PSM]))


def test_odd_rows(odd_docs, no_docs):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for r in odd_docs.collect():
        *head, output = plain_version(r.doc_id, r.text)
        want.append((r.doc_id, *head, sha(output), sha(r.text or "")))
    got = fim.transform_digests(odd_docs)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert fim.transform_digests(no_docs).count() == 0


def test_registered_query_over_whole_table(spark):
    from conftest import SF001
    from flowlake.llm.queries import QUERIES

    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_fill_in_middle"](spark, SF001).collect()}
    assert len(got) == len(docs)
    for r in docs:
        *head, output = plain_version(r.doc_id, r.text)
        assert got[r.doc_id] == (*head, hashlib.sha256(output.encode()).hexdigest(),
                                 hashlib.sha256((r.text or "").encode()).hexdigest())
