"""Encoder, prefix counts, packing and the bit-plane store against the library and exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from flowlake.llm import bitplane_store, packing, prefix_counts
from flowlake.llm.tokens import ChunkEncoder, load_tokenizer
from llm_fixtures import no_docs, odd_docs  # noqa: F401

ODD = ["", " ", "It's  a\tTest\xa0<|endoftext|> x", "İx ŉ ſK K", "a  b   c \n d\n  e", "x'll've 12ab3", "\n\n ok.\nNext. End",
       " ª º. Ⅷ ²x a² é, .", "é combining", "日本語 text", "word " * 300, "strawberries aren't " * 5, "a" * 3000]


def random_texts(n=300):
    rnd = random.Random(4)
    return ["".join(rnd.choices(" \n\tabé.,'sºª9İß²ſ-", k=rnd.randint(0, 40))) for _ in range(n)]


def ids_by_library(name, texts):
    return [e.ids for e in load_tokenizer(name).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("memory", [10, 10 ** 6])
def test_encoder_equals_library(name, memory, monkeypatch):
    monkeypatch.setattr("flowlake.llm.tokens.MEMORY_CHUNKS", memory)
    texts = ODD + random_texts()
    got = ChunkEncoder(name).ids(texts * 2)
    want = [np.array(i, "<u4").tobytes() for i in ids_by_library(name, texts)] * 2
    assert got == want


def test_prefix_counts_equal_library_at_every_prefix():
    name = "word_bpe_49k.json"
    library, counter = load_tokenizer(name), prefix_counts.PrefixCounter(name)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for text in [t[:60] for t in ODD] + random_texts(60) + ["The quick brown fox's internationalization, http://x.org?q=1"]:
        table = counter.table(text)
        every = [count(text[:n]) for n in range(len(text) + 1)]
        assert [table.count(n) for n in range(len(text) + 1)] == every, text
        for budget in range(every[-1] + 2):
            assert table.fits(budget) == max(n for n, c in enumerate(every) if c <= budget), (text, budget)


def test_prefix_counts_of_unusual_letters_equal_library():
    name = "word_bpe_49k.json"
    library, counter = load_tokenizer(name), prefix_counts.PrefixCounter(name)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    rnd = random.Random(6)
    letters = "a'sé\u0301\u0327İΣ日本кий— “”…\xa0\u3000 \x85\u1100\u1161\u11a8각நி1½²!<|\u200d👍\ufeff\x1c\n"
    texts = ["".join(rnd.choices(letters, k=rnd.randint(1, 40))) for _ in range(150)]
    texts += ["x!<|endoftext|>é—<|startoftext|>日本", "<|endoftext|>\u0301", "日本語のテキスト" * 12 + " end", "—" * 90 + "a'll"]
    for text in texts:
        table = counter.table(text)
        every = [count(text[:n]) for n in range(len(text) + 1)]
        assert [table.count(n) for n in range(len(text) + 1)] == every, text
        for budget in range(every[-1] + 2):
            assert table.fits(budget) == max(n for n, c in enumerate(every) if c <= budget), (text, budget)


def test_budget_of_a_long_text_with_a_curly_quote_needs_few_encodings(monkeypatch):
    counter = prefix_counts.PrefixCounter("word_bpe_49k.json")
    calls, encode = [], counter.library.encode

    def watched(texts):
        calls.extend(map(len, texts))
        assert sum(calls) < 1000
        return encode(texts)

    monkeypatch.setattr(counter.library, "encode", watched)
    for text in ["the quick brown fox " * 5000 + "it’s", "日本語のテキスト" * 2000]:
        table = counter.table(text)
        assert 0 < table.fits(2048) < len(text) and len(table.counts) == len(text.split())


def test_token_counts_of_odd_rows(odd_docs, no_docs):
    rows = odd_docs.collect()
    want = sorted((str(r.doc_id), len((r.text or "").encode()), len(i), len(i) > 2048)
                  for r, i in zip(rows, ids_by_library("word_bpe_49k.json", [r.text for r in rows])))
    got = prefix_counts.token_counts(odd_docs).collect()
    assert sorted((str(r[0]), *r[1:4]) for r in got) == want
    assert prefix_counts.token_counts(no_docs).count() == 0
    tables = prefix_counts.prefix_tables(odd_docs.filter("doc_id = 1")).collect()[0]
    assert tables.counts == sorted(tables.counts) and len(tables.ends) == len(tables.counts)


def best_sum(counts, room):
    sums = {0}
    for length, n in counts.items():
        for _ in range(n):
            sums |= {s + length for s in sums if s + length <= room}
    return max(sums)


@pytest.mark.parametrize("seed", range(30))
def test_fullest_multiset_is_best(seed):
    rnd = random.Random(seed)
    counts = {rnd.randint(1, 60): rnd.randint(1, 4) for _ in range(rnd.randint(1, 7))}
    got = packing.fullest_multiset(counts, 64)
    longest = max(counts)
    assert got[longest] >= 1 and all(0 < n <= counts[x] for x, n in got.items())
    rest = {**counts, longest: counts[longest] - 1}
    assert sum(x * n for x, n in got.items()) == longest + best_sum(rest, 64 - longest)


@pytest.mark.parametrize("histogram", [{}, {1: 1}, {1500: 1000}, {63: 5, 1: 3}, {1000: 3, 1048: 3, 7: 1},
                                       {n: (n * 7) % 5 for n in range(1, 2048)}])
def test_plan_places_every_remainder_once(histogram):
    plan = packing.minimum_slack_plan(histogram, 2048)
    windows = defaultdict(list)
    for length, n in histogram.items():
        for rank in range(n):
            if length in plan.laid and rank >= plan.laid[length][0]:
                from_rank, position = plan.laid[length]
                parts = plan.cuts(position + (rank - from_rank) * length, length)
                assert sum(p[0] for p in parts) == length
            else:
                at, each, window, offset = [p for p in plan.places[length] if p[0] <= rank][-1]
                nth, slot = divmod(rank - at, each)
                parts = [(length, window + nth, offset + slot * length)]
            for size, window, offset in parts:
                windows[window].append((offset, size))
    assert sorted(windows) == list(range(plan.first_full))
    for parts in windows.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end == 2048 or end & (end - 1) == 0


def check_pieces(pieces, ids, capacity=2048):
    sequences, places = defaultdict(list), defaultdict(list)
    for r in pieces:
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert len(own) == r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32
        sequences[r.sequence_id].append((r.offset, r.length))
        places[r.doc_id].append((r.start, r.length))
    for parts, total in [(places[d], len(ids[d])) for d in ids] + [(p, None) for p in sequences.values()]:
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end == total if total is not None else end == capacity or end & (end - 1) == 0


def test_pack_every_id_once(spark, odd_docs, no_docs):
    rows = [(i, t) for i, t in enumerate(ODD + random_texts(100) + ["many words of text " * 2000, None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    ids = dict(zip((i for i, _ in rows), [x + [1] for x in ids_by_library("byte_bpe_50k.json", [t for _, t in rows])]))
    pieces = packing.pack(docs)
    found = pieces.collect()
    check_pieces(found, ids)
    sequences = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.packed_sequences(pieces, docs).collect()}
    for r in found:
        own = sequences[r.sequence_id][r.offset:r.offset + r.length]
        assert own.tolist() == ids[r.doc_id][r.start:r.start + r.length]
    total = sum(r.length for r in packing.pack(odd_docs).collect())
    assert total == sum(len(i) + 1 for i in ids_by_library("byte_bpe_50k.json", [r.text for r in odd_docs.collect()]))
    assert packing.pack(no_docs).count() == 0


@pytest.mark.parametrize("n", [1, 7, 8, 9, 1000, 1 << 16])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 49408, n), rng.integers(0, 1 << 32, n), np.zeros(n), np.full(n, (1 << 32) - 1)):
        ids = ids.astype(np.uint32)
        assert bitplane_store.decode_block(bitplane_store.encode_block(ids)).tolist() == ids.tolist()


def test_store_round_trip(spark, odd_docs, no_docs, tmp_path):
    path = str(tmp_path / "ids")
    bitplane_store.write_token_ids(odd_docs, path, block_ids=1000)
    rows = odd_docs.collect()
    ids = [x + [1] for x in ids_by_library("word_bpe_49k.json", [r.text for r in rows])]
    got = bitplane_store.read_token_ids(spark, path).orderBy("start").collect()
    want = sorted((str(r.doc_id), len(i), np.array(i, "<u4").tobytes()) for r, i in zip(rows, ids))
    assert sorted((str(r.doc_id), r.n_tokens, bytes(r.ids)) for r in got) == want
    start = 0
    for r in got:
        assert r.start == start and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        start += r.n_tokens
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    index = bitplane_store.chunk_index(spark, path).collect()
    assert sum(r.n for r in index) == start and all(r.n <= 1000 for r in index)
    empty = str(tmp_path / "none")
    bitplane_store.write_token_ids(no_docs, empty)
    assert bitplane_store.read_token_ids(spark, empty).count() == 0


def test_damaged_store_is_told(spark, odd_docs, tmp_path):
    from pyspark.sql import functions as F
    path, bad = str(tmp_path / "ids"), str(tmp_path / "bad")
    bitplane_store.write_token_ids(odd_docs, path)
    spark.read.parquet(path).withColumn("payload_crc32", F.col("payload_crc32") + 1).write.parquet(bad)
    with pytest.raises(Exception, match="damaged"):
        bitplane_store.read_token_ids(spark, bad).count()
