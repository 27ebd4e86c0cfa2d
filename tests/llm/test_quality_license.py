"""Native operators: base counts by brute force, verdicts, template matches, odd rows."""

import re

import pytest
from flowlake.llm import license_scan, quality_rules
from llm_fixtures import no_docs, odd_docs  # noqa: F401


def base_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for places in seen.values() if len(places) > 1 for i in places for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), failed)


def test_base_counts_of_odd_rows(odd_docs):
    got = quality_rules.quality(odd_docs).collect()
    assert len(got) == odd_docs.count()
    want = sorted((str(r.doc_id), *base_counts(r.text)) for r in odd_docs.collect())
    assert sorted((str(r.doc_id), *r[1:7]) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)


def test_many_different_repeated_windows(spark):
    text = " ".join(f"w{i % 300}" for i in range(700)) + "\n" + "\n".join(["line a"] * 3)
    docs = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    r = quality_rules.quality(docs).collect()[0]
    assert tuple(r[1:7]) == base_counts(text)


def test_quality_empty_table(no_docs):
    assert quality_rules.quality(no_docs).count() == 0


def test_running_text_is_kept_and_symbol_runs_are_not(spark):
    import random
    rnd = random.Random(3)
    words = "the of and to in a is that it was for on are as with be by at this from".split()
    def prose(n):
        return " ".join(rnd.choice(words) if rnd.random() < 0.4 else "".join(rnd.choices("etaoinshr", k=5)) for _ in range(n))
    rows = [(i, prose(300) + ".", "en") for i in range(40)]
    rows += [(100, " ".join(w + "%%%&&&" for w in prose(300).split()), "en"), (101, prose(300).upper() + "!!", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in quality_rules.quality(docs).collect()}
    assert all(kept[i] for i in range(40))
    assert not kept[100] and not kept[101]


def test_every_language_of_the_table_is_a_reference(spark):
    import random
    rnd = random.Random(5)
    words = {"en": "the of and to in a is that it was".split(), "it": "di che e la il un a per in una sono".split()}
    def prose(lang):
        return " ".join(rnd.choice(words[lang]) if rnd.random() < 0.5 else "".join(rnd.choices("etaoinshr", k=6)) for _ in range(120))
    rows = [(i, prose(lang), lang) for i, lang in enumerate(["en"] * 60 + ["it"] * 50)]
    rows += [(200, " ".join("".join(rnd.choices("etaoinshr", k=6)) for _ in range(400)), "zz"), (201, prose("it"), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    references = quality_rules.language_references(docs, quality_rules.Divergence())
    assert sorted(references) == ["en", "it"]  # zz has fewer words than a reference needs
    assert set(words["it"]) <= set(references["it"].common) and len(references["it"].common) == 20
    kept = {r.doc_id: r.kept for r in quality_rules.quality(docs).collect()}
    assert all(kept[i] for i in range(110)) and kept[201]
    assert not kept[200]


def license_truth(text, percent=90):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    cut = lambda x: re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", x)
    words = cut(low)
    places = sorted((i, label) for phrase, label in license_scan.PHRASES.items() for i in range(len(words))
                    if words[i:i + len(phrase.split())] == phrase.split())
    more, score = set(), 0.0
    lines = [cut(line) for line in low.split("\n")]
    ahead = max(len(cut(t)) for _, t in license_scan.TEMPLATES)
    for i, own in enumerate(lines):
        after = []
        for line in lines[i + 1:]:
            if not line:
                break
            after += line
        for label, template in license_scan.TEMPLATES:
            t = license_scan.token_set(template)
            n = len(t & set(own + after[:ahead]))
            if 100 * n >= percent * len(t):
                more.add(label)
                score = max(score, n / len(t))
    base = {label for _, label in places}
    return (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
            ",".join(sorted(base)), ",".join(sorted(base | more)), pytest.approx(score))


TEXTS = [
    "CC-BY 4.0 and cc by, General Public\nLicense. ALL RIGHTS RESERVED", "cc by", "xcc by ccby éall rights reserved",
    "Intro\nReleased under the MIT License.\nEnd", "Released under the\nMIT License", "the mit license released under",
    "Licensed under CC BY-NC 4.0.", "licensed under the apache license version 2 0 and more words", "all rights all rights reserved",
    "This work is licensed under the GNU General Public License, version 3. " * 3, "LİCENSE cc by K", None, "", "general public license general public license",
]


WRAPPED = {
    "mit": "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and "
           "associated documentation files (the Software)",
    "bsd": " * Redistribution and use in source and binary forms,\n * with or without modification,\n * are permitted provided",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy",
}


@pytest.mark.parametrize("label", sorted(WRAPPED))
def test_wrapped_notices_are_found(spark, label):
    texts = [WRAPPED[label], "some words before it\n" + WRAPPED[label] + "\nand after", WRAPPED[label].replace("\n", "\n\n")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.license_scan(docs).collect()}
    assert got[0] == got[1] == (label, 1.0)
    assert got[2] == ("", 0.0)  # a blank line ends a block


def test_license_scan_against_brute_force(spark, odd_docs):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for got in license_scan.license_scan(docs).collect():
        assert tuple(got[1:]) == license_truth(TEXTS[got.doc_id]), TEXTS[got.doc_id]
    got = license_scan.license_scan(odd_docs).collect()
    want = sorted((str(r.doc_id), license_truth(r.text)[0]) for r in odd_docs.collect())
    assert sorted((str(r.doc_id), r.n_words) for r in got) == want


def test_license_scan_empty_and_native(spark, no_docs, odd_docs):
    assert license_scan.license_scan(no_docs).count() == 0
    for df in (license_scan.license_scan(odd_docs), quality_rules.quality(odd_docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
