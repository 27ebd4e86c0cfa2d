"""Balanced label propagation: even shards, whole groups, counts of cut links against brute force."""

import collections
import random
import zlib

import pytest
from flowlake.llm import sharding
from llm_fixtures import no_docs, odd_docs  # noqa: F401


def check_law(rows, docs, shards):
    """Even counts, gapless slots, sizes and checksums; rows: result, docs: (doc_id, text)."""
    counts = collections.Counter(r.shard for r in rows)
    sizes = [counts[s] for s in range(shards)]
    assert sum(sizes) == len(docs) and max(sizes) - min(sizes) <= 1
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    key = lambda x: tuple(str(v) for v in x)
    want = [(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs]
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=key) == sorted(want, key=key)


def cut_links(rows, docs):
    """(doc_id, shard) -> rows of the same text, and those of them in other shards."""
    text = dict(docs)
    places = collections.defaultdict(collections.Counter)
    for r in rows:
        if text[r.doc_id] is not None:
            places[text[r.doc_id]][r.shard] += 1
    for r in rows:
        own = places[text[r.doc_id]]
        n = sum(own.values())
        assert (r.n_linked, r.n_cut) == ((0, 0) if n < 2 else (n - 1, n - own[r.shard]))
    return places


def groups_of(sizes, singles):
    texts = [f"group {g}" for g, n in enumerate(sizes) for _ in range(n)] + [f"single é {i}" for i in range(singles)]
    random.Random(4).shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("sizes, singles, shards", [
    ([2] * 60 + [7] * 10 + [30], 400, 16),
    ([400, 90, 3, 2], 505, 16),  # a group larger than a shard
    ([5] * 40, 0, 4),  # no row without links
    ([], 10, 16), ([2], 0, 16), ([3, 3], 1, 1)])
def test_shards_are_even_and_groups_stay_together(spark, sizes, singles, shards):
    docs = groups_of(sizes, singles)
    rows = sharding.balanced_shards(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), shards).collect()
    check_law(rows, docs, shards)
    places = cut_links(rows, docs)
    if singles > 100:
        quota = len(docs) // shards
        for g, n in enumerate(sizes):
            assert len(places[f"group {g}"]) <= -(-n // quota) + (n > quota), (g, n, places[f"group {g}"])


def test_links_of_several_kinds_pull_together(spark):
    docs = [(i, f"t{i // 2}", f"site {i % 20}") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, site string").repartition(4)
    rows = sharding.balanced_shards(df, 4, link_by=("site", "text")).collect()
    check_law(rows, [d[:2] for d in docs], 4)
    before = sum(1 for i in range(400) for j in range(400) if i % 20 == j % 20 and i != j) * 3 / 4
    assert sum(r.n_cut for r in rows) < 0.6 * before  # dealt at random, three quarters would be cut
    assert all(r.n_linked == 20 for r in rows)


def test_grants_keep_every_quota():
    rnd = random.Random(1)
    for _ in range(200):
        shards = rnd.randint(2, 6)
        linked = [rnd.randint(0, 50) for _ in range(shards)]
        quota = [n + rnd.choice([0, 0, 3, 40]) for n in linked]
        wishes = {(a, b): rnd.randint(0, linked[a] // (shards - 1)) for a in range(shards) for b in range(shards) if a != b}
        x = sharding.grants(wishes, linked, quota)
        assert all(0 < n <= wishes[m] for m, n in x.items())
        for s in range(shards):
            after = linked[s] + sum(n for (_, b), n in x.items() if b == s) - sum(n for (a, _), n in x.items() if a == s)
            assert after <= quota[s]
    assert sharding.grants({(0, 1): 5, (1, 0): 5}, [9, 9], [9, 9]) == {(0, 1): 5, (1, 0): 5}  # full shards exchange rows


def test_odd_rows(odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows = sharding.balanced_shards(odd_docs, 3).collect()
    check_law(rows, docs, 3)
    assert sum(r.n_linked == 1 for r in rows if r.doc_id in (1, 2, 9)) == 4
    assert sharding.balanced_shards(no_docs).count() == 0


def test_no_python_in_the_plans(spark, odd_docs):
    plan = sharding.balanced_shards(odd_docs, 3)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_registered_query_over_whole_table(spark):
    from conftest import SF001
    from flowlake.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rows = QUERIES["op11_sharding"](spark, SF001).collect()
    check_law(rows, docs, 16)
    cut_links(rows, docs)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
