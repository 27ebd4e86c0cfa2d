"""Language ID (gradients, accuracy, odd rows), page text, containment search, pipeline and entry."""

import numpy as np
import pytest
from flowlake.llm import decontaminate, language_id, page_text
from flowlake.llm.common import table
from llm_fixtures import no_docs, odd_docs  # noqa: F401

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def test_scorer_equals_plain_forward_pass():
    rng = np.random.default_rng(1)
    h, k = 5, 3
    model = language_id.BiGru(list("abc"), *(rng.normal(0, 0.5, s).astype(np.float32) for s in (
        (2, 256, 3 * h), (2, h, 3 * h), (2, h, k), (k,))))
    texts = [bytes(rng.integers(0, 256, n).astype(np.uint8)) for n in (1, 5, 16, 17, 40)] + [b""]

    def distribution(raw):
        total = np.zeros(k)
        for at in range(0, len(raw), 16):
            part, states = raw[at:at + 16], []
            for way in (0, 1):
                state, run = np.zeros(h), []
                for b in part[::-1] if way else part:
                    a, g = model.wx[way][b], state @ model.wh[way]
                    z, r = (1 / (1 + np.exp(-(a[i * h:(i + 1) * h] + g[i * h:(i + 1) * h]))) for i in (0, 1))
                    c = np.tanh(a[2 * h:] + r * g[2 * h:])
                    state = c + z * (state - c)
                    run.append(state)
                states.append(run[::-1] if way else run)
            for f, b in zip(*states):
                e = np.exp(f @ model.wo[0] + b @ model.wo[1] + model.bo)
                total += e / e.sum()
        return total / max(len(raw), 1)

    buf = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = language_id.Scorer(model).documents(buf, offsets, width=16, rows=3)
    assert np.allclose(got, [distribution(t) for t in texts], atol=1e-5)


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(2)
    h, k, t = 3, 3, 7
    p = {name: rng.normal(0, 0.5, shape) for name, shape in
         {"wx": (2, 256, 3 * h), "wh": (2, h, 3 * h), "wo": (2, h, k), "bo": (k,)}.items()}
    x, y = rng.integers(60, 66, (4, t)), np.array([0, 1, 2, 1])
    _, grad = language_id.loss_and_gradients(p, x, y)
    for name, weights in p.items():
        if name == "wx":
            assert not grad[name][:, 66:].any()  # bytes that do not occur
        places = list(np.ndindex(weights.shape)) if name != "wx" else [(w, b, i) for w in (0, 1) for b in (60, 63, 65) for i in range(3 * h)]
        for at in places:
            kept, eps, losses = weights[at], 1e-5, []
            for way in (1, -1):
                weights[at] = kept + way * eps
                losses.append(language_id.loss_and_gradients(p, x, y)[0])
            weights[at] = kept
            assert abs((losses[0] - losses[1]) / (2 * eps) - grad[name][at]) < 1e-8, (name, at)


def test_rare_languages_are_learned(spark):
    rng = np.random.default_rng(4)
    words = {"aa": "lumo tepi sanu", "bb": "krex vordt gnilk", "cc": "zhuia oaeo iuyy"}
    rows = [(i, " ".join(rng.choice(words[lang].split(), 20)), lang) for i, lang in enumerate(
        ["aa"] * 700 + ["bb"] * 700 + ["cc"] * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit_language_model(docs, sample_rows=60, steps=120)
    assert model.labels == ["aa", "bb", "cc"]
    found = {r.doc_id: r.lang_pred for r in language_id.language_id(docs, model).collect()}
    assert sum(found[d] == lang for d, _, lang in rows if lang == "cc") == 12
    assert sum(found[d] == lang for d, _, lang in rows) > 0.98 * len(rows)


def test_held_out_accuracy(spark):
    docs = table(spark, SF01, "documents")
    model = language_id.fit_language_model(docs)
    rows = {r.doc_id: r for r in language_id.language_id(docs, model).collect()}
    import zlib
    truth = [(r.doc_id, r.lang) for r in docs.filter("lang is not null and length(text) > 40").collect()]
    assert all(rows[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, _ in truth)
    held = [(d, lang) for d, lang in truth if rows[d].held_out]
    assert sum(rows[d].lang_pred == lang for d, lang in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_language_of_odd_rows(odd_docs, no_docs):
    model = language_id.fit_language_model(odd_docs, steps=5)
    rows = language_id.language_id(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    und = [r for r in rows if r.lang_pred == "und"]
    assert {r.doc_id for r in und} == {4, 5, 6, 11, None} and all(r.score == 0 for r in und) and len(und) == 5
    assert {r.lang_pred for r in rows} <= {"en", "fr", "und"}
    kept = language_id.keep_identified(odd_docs, model, min_score=0.0)
    assert kept.columns == odd_docs.columns and kept.count() == len(rows) - 5
    assert language_id.fit_language_model(no_docs) is None
    assert language_id.language_id(no_docs, None).count() == 0
    assert {r.lang_pred for r in language_id.language_id(odd_docs, None).collect()} == {"und"}


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no";</script></head><body>
<header>Site</header><nav><ul><li><a href="x">Menu</a></ul></nav><div class="cookie-notice">We use</div>
<article><header><h1>Head &amp; line</h1></header><p>One  <b>bold<br>
two</b> &eacute;&#33;<p>Three<!-- no --> four<ul><li>Item<li>Other</ul><div class="ad-box">Buy</div>
<pre> a
 b </pre><form>Search <input></form><section id="comments"><p>First!</p></section></article>
<aside>Side</aside><div class="site_footer">&copy; x</div></body></html>"""


@pytest.mark.parametrize("source, text", [
    (PAGE, "Head & line\n\nOne bold two é!\n\nThree four\n\nItem\n\nOther\n\na b"),
    ("", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>a<p>b", "a\n\nb"), ("<p>a</i></b>c</p>d", "ac\n\nd"),
    ("<article>x</article><article class=comment>y</article><article>z", "x\n\nz"),
    ("<main><h1>H</h1>t</main>out", "H\n\nt"), ("<div>" * 3000 + "deep", "deep"), ("<p title='>'>q</p>", "q"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"), ("a < b <3", "a < b <3"), ("<script>x", ""), ("<!-- x", ""),
])
def test_main_text(source, text):
    assert page_text.main_text(source) == text


def test_site_template_goes(spark):
    pages = [(i, f"http://Host.example/{i}", f"<body><div><p>Own text {i}</p></div><div><p>Every page has this</p></div></body>")
             for i in range(20)]
    pages += [(100 + i, f"https://other.example:80/{i}", f"<p>Alone {i}</p><p>Every page has this</p>") for i in range(3)]
    copies = [(200 + i, f"http://copies.example/{i}", "<p>The same page</p>") for i in range(30)]
    odd = [(300, None, "<p>x</p>"), (301, "no url", None), (None, "http://host.example/", ""), (303, "", "<p>y</p>")]
    rows = [(*r, "h") for r in pages + copies + odd + odd]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = page_text.page_texts(df).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert all(text[i] == f"Own text {i}" for i in range(20))
    assert text[101] == "Alone 1\n\nEvery page has this" and text[205] == "The same page"
    assert (text[300], text[301], text[None], text[303]) == ("x", "", "", "y")
    assert page_text.page_texts(df.limit(0)).count() == 0


def test_small_hosts_and_sections_lose_their_menus(spark):
    menu = "<div><ul><li><a href='/'>Start</a><li><a href='/x'>More of it</a></ul></div>"
    own = lambda i: f"<div><p>Own text {i}, see <a href='z'>the list</a> for more</p></div>"
    text = lambda i: f"Own text {i}, see the list for more"
    rows = [(i, f"http://five.example/{i}", f"<body>{menu}{own(i)}<div>A plain notice</div></body>") for i in range(5)]
    # a section's menu and notice on 10 of 30 pages
    rows += [(100 + i, f"http://thirty.example/{'news' if i < 10 else 'other'}/{i}",
              f"<body>{menu + '<div>Press notice</div>' if i < 10 else ''}{own(i)}</body>") for i in range(30)]
    # an article's own blocks: a passage on 6 of 30 pages, a link line on 4
    rows += [(200 + i, f"http://article.example/{i}",
              f"<article><p>{text(i)}</p>{'<p>Copied passage</p>' if i < 6 else ''}"
              f"{'<p><a>Source</a></p>' if i < 4 else ''}</article>") for i in range(30)]
    rows += [(300 + i, f"http://two.example/{i}", f"<p>Twice</p>{own(i)}") for i in range(2)]
    got = {r.page_id: r.text for r in page_text.page_texts(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == text(i) for i in range(5))
    assert all(got[100 + i] == text(i) for i in range(30))
    assert got[203] == f"{text(3)}\n\nCopied passage\n\nSource" and got[205] == f"{text(5)}\n\nCopied passage"
    assert got[301] == f"Twice\n\n{text(1)}"


def contained(docs, items, n=5, percent=80):
    from test_near_suffix import shingles
    return sorted((str(d), str(i), len(q), len(q & s)) for d, t in set(docs) for i, u in set(items)
                  for s, q in [(shingles(t, n), shingles(u, n))] if q and 100 * len(q & s) >= percent * len(q))


@pytest.mark.parametrize("bound", [0, 2_000_000])
def test_contained_items_equal_brute_force(spark, odd_docs, bound):
    import random
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdef", k=4)) for _ in range(300)]
    text = lambda n: " ".join(rnd.choices(words, k=n))
    items = [(i, text(rnd.randint(6, 60))) for i in range(30)] + [(90, "word"), (91, ""), (92, None), (93, "two words")]
    items += [(93, "two words"), (None, text(20)), (94, items[3][1])]
    docs = [(i, text(rnd.randint(5, 300))) for i in range(60)]
    for i in range(60, 160):  # items inside texts, some with words changed or in two halves
        part = rnd.choice(items[:30])[1].split()
        for _ in range(rnd.randint(0, 3)):
            part[rnd.randrange(len(part))] = rnd.choice(words)
        cut = rnd.choice([0, 0, len(part) // 2])
        docs.append((i, " ".join([text(100), *part[cut:], text(50), *part[:cut], text(40)]).upper()))
    docs += [(r.doc_id, r.text) for r in odd_docs.collect()]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, size int")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, sketch int")
    got = decontaminate.contained_items(d, b, bound=bound).drop("k1", "k2").collect()
    assert sorted((str(r[0]), str(r[1]), *r[2:]) for r in got) == contained(docs, items)
    clean = decontaminate.without_contaminated(d, b)
    assert clean.columns == d.columns
    bad = {x[0] for x in contained(docs, items)}
    assert {str(r.doc_id) for r in clean.collect()} >= {str(i) for i, _ in docs} - bad
    shared = {str(r.doc_id) for r in odd_docs.collect()}  # ids that other rows have too
    assert not {str(r.doc_id) for r in clean.collect()} & (bad - shared) and bad - shared


def test_contained_items_of_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "some words of an item here")], "item_id long, text string")
    assert decontaminate.contained_items(no_docs, items).count() == 0
    assert decontaminate.contained_items(odd_docs, items.limit(0)).count() == 0
    assert decontaminate.without_contaminated(odd_docs, items.limit(0)).count() == odd_docs.count()


def test_pipeline_stages_one_after_another_on_odd_rows(spark, odd_docs):
    import corpus_pipeline as cp
    docs = odd_docs
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF001).cache()
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        assert not {str(r.doc_id) for r in out.collect()} - {str(r.doc_id) for r in docs.collect()}, name
        docs = out
    # rows without a letter go, and all but one of equal rows
    left = [r.doc_id for r in docs.collect()]
    assert not {4, 5, 6, 11} & set(left) and len({1, 2} & set(left)) == 1 and len({7, 8} & set(left)) <= 1
    assert left.count(9) <= 2 and left.count(None) <= 1
    packed = cp.STAGES[-1][1](spark, docs, SF001)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(left)


def test_pipeline_stages_on_odd_rows(spark, odd_docs, no_docs):
    import corpus_pipeline as cp
    documents = table(spark, SF001, "documents")
    for docs in (documents, documents.limit(0)):
        ids = docs.count()
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, SF001)
            assert out.columns == documents.columns and [f.dataType for f in out.schema] == [f.dataType for f in documents.schema]
            out = out.cache()
            assert out.count() <= ids, name
            docs, ids = out, out.count()
        packed = cp.STAGES[-1][1](spark, docs, SF001)
        assert packed.select("doc_id").distinct().count() == ids


def test_registered_queries_and_oracles(spark):
    import importlib.util
    import os

    import __spark_entry__ as entry
    spec = importlib.util.spec_from_file_location(
        "oracle_check", os.path.join(os.path.dirname(entry.__file__), "scripts", "oracle_check.py"))
    oc = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(oc)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for n in range(1, 11):
        assert len([q for q in queries if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in queries
    for key in [q for q in oracles if q.startswith("op")]:
        a = oc.pandas_view(queries[key](spark, SF001).toPandas())
        b = oc.pandas_view(oc.duck(SF001).execute(oracles[key]).df())
        assert a == b, key
