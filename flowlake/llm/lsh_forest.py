"""MinHash near-duplicate groups by an LSH forest.

A document is its set of distinct word shingles (ASCII lower case, words split
at ASCII white space). Documents with equal sets form a class; one member
stands for it. Every class has a MinHash signature cut into trees: each tree
orders all classes by its own part of the signature, and classes next to each
other in an order that share a long prefix are candidates. How long it must be
adapts to the region: where many classes share a prefix, deeper levels are
asked for until few are left together. Candidates are confirmed by the Jaccard
similarity of their full shingle sets, strongest candidates first; the rest
only where they would still join two different groups. Classes whose regions are
so dense that a link might be among none of their candidates meet in an exact
join: prefixes of their shingle sets, rarest shingles first, with length and
positional filters, where they would still join two different groups.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, arrow_bytes, gathered, internal, keyed, mix64, row_groups, row_keys, words_of, written
from .components import connected_components


@dataclass(frozen=True)
class Forest:
    """trees orders of ``depth`` levels each; two sets are never candidates with
    fewer than ``min_depth`` common levels, nor further apart than ``reach``
    places in an order. At similarity 0.8 a lone pair is missed by all 24 trees
    with probability (1 - 0.8**4)**24, about 4 in a million. Classes whose links
    might be missed with a probability over ``missed``, because their regions
    ask for more levels or stay larger than the reach, are joined exactly."""

    trees: int = 24
    depth: int = 10
    min_depth: int = 4
    reach: int = 7
    missed: float = 1e-5


SIGNATURES = "k1 long, k2 long, doc_id long, n_shingles long, c1 long, signature binary"
NEIGHBOURS = "kind int, a long, b long, tree int, key binary"
ENTRIES = "token long, c1 long, root long, n int, place int, indexed boolean"
#: Shingles are ordered by how often their bucket occurs: one count a bucket, whatever the corpus.
BUCKET_BITS = 20
#: Places of an order that are looked at together.
PART_ROWS = 1 << 16
#: Rows of one shingle that a task of the exact join compares with the shingle's others.
SALT_ROWS = 1000


def shingle_rows(buf: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each document of the buffer.

    Fewer words than a shingle has: the whole word sequence is the one shingle.
    """
    low = buf.copy()
    low[(low >= 65) & (low <= 90)] += 32
    start, word = words_of(low, offsets)
    bounds = np.searchsorted(start, offsets)
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        own = word[lo:hi]
        n = max(min(words, len(own)), 1)
        if not len(own):
            yield own
            continue
        mixed = np.full(len(own) - n + 1, n, U64)
        for k in range(n):
            mixed = mix64(mixed * U64(0x9E3779B97F4A7C15) + own[k:len(own) - n + 1 + k])
        yield np.unique(mixed)


def _signature(shingles: np.ndarray, multipliers: np.ndarray) -> bytes:
    low = np.full(len(multipliers), 0xFFFFFFFF, np.uint32)
    x = (shingles >> U64(32)).astype(np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(low, (multipliers[:, None] * x[None, at:at + 1024]).min(axis=1), out=low)
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(">u2").tobytes()


def signatures(docs: DataFrame, words: int, forest: Forest) -> DataFrame:
    """Row keys, set size, class (64-bit hash of the set; null if empty) and signature of every row."""
    rng = np.random.default_rng(11)
    multipliers = (rng.integers(0, 1 << 32, forest.trees * forest.depth, dtype=np.uint64) | U64(1)).astype(np.uint32)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            sizes, classes, signed = [], [], []
            for lo, hi in row_groups(offsets, 1 << 20):
                part = buf[offsets[lo]:offsets[hi]]
                for s in shingle_rows(part, offsets[lo:hi + 1] - offsets[lo], words):
                    sizes.append(len(s))
                    if len(s):
                        total = mix64(s).sum(dtype=U64, keepdims=True) + U64(len(s))
                        classes.append(int(mix64(total).view(np.int64)[0]))
                        signed.append(_signature(s, multipliers))
                    else:
                        classes.append(None)
                        signed.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1"), batch.column("k2"), batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(classes, pa.int64()), pa.array(signed, pa.binary())],
                names=["k1", "k2", "doc_id", "n_shingles", "c1", "signature"])

    return keyed(docs).mapInArrow(sign, SIGNATURES)


def _region_depths(common: np.ndarray, forest: Forest) -> np.ndarray:
    """Levels asked of each place: the fewest at which its region is no larger than the reach.

    One more than there are where even the whole key leaves it larger.
    """
    n = len(common) + 1
    depth = np.full(n, forest.depth + 1)
    open_ = np.ones(n, bool)
    for level in range(forest.min_depth, forest.depth + 1):
        region = np.concatenate([[0], np.cumsum(common < level)])
        small = np.bincount(region)[region] <= forest.reach + 1
        depth[open_ & small] = level
        open_ &= ~small
    return depth


def neighbours(tree: np.ndarray, key: np.ndarray, ids: np.ndarray, forest: Forest):
    """Candidate pairs of one sorted run, (a, b, hub) arrays, and the levels asked of each place.

    hub marks pairs of a region's members with the region's smallest id.
    """
    n = len(ids)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.full(n, forest.min_depth)

    def shared(i, j):
        return (tree[i] == tree[j]) * np.cumprod(key[i] == key[j], axis=1).sum(1)

    at = np.arange(n)
    common = shared(at[:-1], at[1:])
    wanted = _region_depths(common, forest)
    depth = np.minimum(wanted, forest.depth)
    a, b, hub = [], [], []
    for far in range(1, forest.reach + 1):
        i, j = at[:-far], at[far:]
        length = common if far == 1 else shared(i, j)
        asked = forest.min_depth if far == 1 else np.minimum(depth[i], depth[j])
        ok = length >= asked
        a.append(ids[i[ok]]), b.append(ids[j[ok]]), hub.append(np.zeros(ok.sum(), bool))
    region = np.concatenate([[0], np.cumsum(common < forest.min_depth)])
    starts = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]]))
    head = np.minimum.reduceat(ids, starts)[region]
    other = head != ids
    a.append(head[other]), b.append(ids[other]), hub.append(np.ones(other.sum(), bool))
    return np.concatenate(a), np.concatenate(b), np.concatenate(hub), wanted


def candidate_pairs(classes: DataFrame, forest: Forest, percent: int) -> tuple[DataFrame, DataFrame]:
    """(a, b, votes, hub_votes): class pairs found in any tree, a < b, with the places they were found.

    Each order is cut into ranges; what stands at the ends of a range goes
    through a second, small pass, so no neighbours are lost at the cuts.
    The second table (c1) has the classes of dense regions, of which a link may
    be missed by all trees with a probability over ``forest.missed``.
    """
    width = 2 * forest.depth
    rows = (classes.select("c1", F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1))).alias("tree"), "signature")
            .select("tree", F.substring("signature", F.col("tree") * width + 1, F.lit(width)).alias("key"),
                    F.col("c1").alias("a")))

    def run(batches, with_ends: bool):
        # a range is gone through in parts with ends of their own; the ends are few and go through whole
        for part in gathered(batches, PART_ROWS if with_ends else sys.maxsize):
            yield from found_in(part, with_ends)

    def found_in(whole: pa.RecordBatch, with_ends: bool):
        tree = whole.column("tree").to_numpy()
        ids = whole.column("a").to_numpy()
        raw, _ = arrow_bytes(whole.column("key"))
        key = raw.view(">u2").reshape(-1, forest.depth)
        a, b, hub, depth = neighbours(tree, key, ids, forest)
        a, b = np.minimum(a, b), np.maximum(a, b)
        ok = a != b
        n = int(ok.sum())
        at = np.arange(len(ids))
        # one more than the reach, so that a region cut in two is seen to be larger than it
        end = with_ends & ((at <= forest.reach) | (at >= len(ids) - forest.reach - 1))
        if not with_ends:
            depth = np.maximum(depth, whole.column("b").to_numpy())
        yield pa.RecordBatch.from_arrays(
            [pa.array(hub[ok].astype(np.int32)), pa.array(a[ok]), pa.array(b[ok]), pa.nulls(n, pa.int32()),
             pa.nulls(n, pa.binary())], names=["kind", "a", "b", "tree", "key"])
        deep = np.flatnonzero((depth > forest.min_depth) & ~end)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(deep), 3, np.int32)), pa.array(ids[deep]), pa.array(depth[deep].astype(np.int64)),
             pa.nulls(len(deep), pa.int32()), pa.nulls(len(deep), pa.binary())],
            names=["kind", "a", "b", "tree", "key"])
        if with_ends:
            at = at[end]
            ends = whole.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), 2, np.int32)), ends.column("a"), pa.array(depth[at].astype(np.int64)),
                 ends.column("tree"), ends.column("key").cast(pa.binary())], names=["kind", "a", "b", "tree", "key"])

    partitions = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(partitions, "tree", "key", "a").sortWithinPartitions("tree", "key", "a")
    found = written(ordered.mapInArrow(lambda it: run(it, True), NEIGHBOURS), "forest")
    ends = found.filter("kind = 2").select("tree", "key", "a", "b")
    across = written(ends.repartition("tree").sortWithinPartitions("tree", "key", "a")
                     .mapInArrow(lambda it: run(it, False), NEIGHBOURS), "forest-ends")
    pairs = (found.filter("kind < 2").union(across.filter("kind < 2"))
             .groupBy("a", "b").agg(F.count_if(F.col("kind") == 0).alias("votes"), F.sum("kind").alias("hub_votes")))
    # log of the probability that no tree finds a link at the threshold; deeper levels find fewer
    similar = min(percent / 100, 0.999)
    lost = [math.log1p(-similar ** d) if 0 < d <= forest.depth else 0.0 for d in range(forest.depth + 2)]
    flat, limit = lost[forest.min_depth] * forest.trees, math.log(forest.missed)
    deep = found.filter("kind = 3").union(across.filter("kind = 3"))
    more = F.array(*[F.lit(x - lost[forest.min_depth]) for x in lost])[F.col("b").cast("int")]
    missed = deep.groupBy(F.col("a").alias("c1")).agg(F.sum(more).alias("more"))
    if flat > limit:
        missed = classes.select("c1").join(missed, "c1", "left")
    return pairs, missed.filter(F.coalesce("more", F.lit(0.0)) + flat > limit).select("c1")


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * |A and B| >= percent * |A or B| on full shingle sets."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sets(column):
            buf, offsets = arrow_bytes(column)
            for lo, hi in row_groups(offsets, 1 << 20):
                yield from shingle_rows(buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], words)

        for batch in batches:
            keep = []
            for x, y in zip(sets(batch.column("text_a")), sets(batch.column("text_b"))):
                small, large = min(len(x), len(y)), max(len(x), len(y))
                ok = 100 * small >= percent * large
                if ok:
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok = 100 * both >= percent * (len(x) + len(y) - both)
                keep.append(ok)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    left = texts.select(F.col("c1").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("c1").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(check, "a long, b long")


def _bucket_counts(texts: DataFrame, words: int) -> np.ndarray:
    """How many sets hold a shingle of each bucket; one number a bucket reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            for lo, hi in row_groups(offsets, 1 << 20):
                for s in shingle_rows(buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], words):
                    np.add.at(total, (s >> U64(64 - BUCKET_BITS)).view(np.int64), 1)
        at = np.flatnonzero(total)
        for lo in range(0, len(at), 1 << 16):
            part = at[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["bucket", "n"])

    sums = (texts.select("text").mapInArrow(count, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    counts[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return counts


def links_between_groups(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): every pair of different groups that may be linked, for texts with c1, root and text.

    Exact prefix join. All shingles stand in one order, rarest first. Of a set
    of n shingles and a smaller one at similarity ``percent`` / 100, one of the
    first n - ceil(percent n / 100) + 1 of the larger is among the first
    m - ceil(2 percent m / (100 + percent)) + 1 of the smaller one's m, and
    enough are left after the first common one. A shingle met in one group only
    is left out; one met often is dealt to several tasks.
    """
    counts = _bucket_counts(texts, words)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = arrow_bytes(batch.column("text"))
            c1, root = batch.column("c1").to_numpy(), batch.column("root").to_numpy()
            for lo, hi in row_groups(offsets, 1 << 20):
                sets = shingle_rows(buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], words)
                firsts, sizes, kept, indexed = [], [], [], []
                for s in sets:
                    n = len(s)
                    first = n + percent * n // -100 + 1 if n else 0
                    order = np.lexsort((s, counts[(s >> U64(64 - BUCKET_BITS)).view(np.int64)]))[:first]
                    firsts.append(s[order].view(np.int64)), sizes.append(n), kept.append(first)
                    indexed.append(np.arange(first) < n + 2 * percent * n // -(100 + percent) + 1)
                place = [np.arange(k, dtype=np.int32) for k in kept]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(firsts)), pa.array(np.repeat(c1[lo:hi], kept)),
                     pa.array(np.repeat(root[lo:hi], kept)), pa.array(np.repeat(np.array(sizes, np.int32), kept)),
                     pa.array(np.concatenate(place)), pa.array(np.concatenate(indexed))],
                    names=["token", "c1", "root", "n", "place", "indexed"])

    entries = written(texts.select("c1", "root", "text").mapInArrow(enter, ENTRIES), "entries")
    tokens = entries.groupBy("token").agg(F.count(F.lit(1)).alias("rows"), F.min("root").alias("low"),
                                          F.max("root").alias("high"))
    tokens = written(tokens.filter("low < high").select("token", F.ceil(F.col("rows") / SALT_ROWS).alias("salts")),
                     "tokens")
    met = written(entries.join(tokens, "token"), "met")
    long = met.select("token", F.pmod(F.xxhash64("c1"), "salts").alias("salt"), "c1", "root", "n", "place")
    short = met.filter("indexed").select(
        "token", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
        F.col("c1").alias("c2"), F.col("root").alias("root2"), F.col("n").alias("n2"), F.col("place").alias("place2"))
    left = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
    smaller = (F.col("n2") < F.col("n")) | ((F.col("n2") == F.col("n")) & (F.col("c2") < F.col("c1")))
    pairs = long.join(short, ["token", "salt"]).filter(
        (F.col("root") != F.col("root2")) & smaller & (F.col("n2") * 100 >= F.col("n") * percent)
        & (left * (100 + percent) >= (F.col("n") + F.col("n2")) * percent))
    return pairs.select(F.least("c1", "c2").alias("a"), F.greatest("c1", "c2").alias("b")).distinct()


def near_duplicate_groups(docs: DataFrame, words: int = 2, percent: int = 80, forest: Forest = Forest()) -> DataFrame:
    """k1, k2, doc_id, n_shingles, component and component_id of every row.

    Rows are linked when the Jaccard similarity of their shingle sets is at
    least ``percent`` / 100; component_id is the smallest doc_id reachable over
    links, the own one included, and ``component`` names the same group by a
    number that is null only for rows without shingles. Null, empty and wordless texts have no
    shingles and are linked with nothing. Rows with a null doc_id take part;
    they get the smallest non-null id of their component, or null if it has
    none. Repeated rows are copies like any other. Further columns of ``docs``
    are not read. Sets are compared as sets of 64-bit shingle hashes, and a
    64-bit hash of the set names a class.
    """
    signed = written(signatures(docs, words, forest), "signed")
    full = signed.filter("n_shingles > 0")
    classes = full.groupBy("c1").agg(
        F.min("doc_id").alias("min_doc"), F.any_value("signature").alias("signature"),
        F.min(F.struct("k1", "k2")).alias("rep"))
    classes = written(classes, "classes")
    pairs, dense = candidate_pairs(classes, forest, percent)
    pairs, dense = written(pairs, "pairs"), written(dense, "dense")
    nodes = pairs.select(F.col("a").alias("c1")).union(pairs.select("b")).union(dense).distinct()
    reps = classes.join(nodes, "c1", "left_semi").select("c1", F.col("rep.k1").alias("k1"), F.col("rep.k2").alias("k2"))
    # identical rows share their keys: one text for each class, within the join's partitioning
    texts = written(keyed(docs).select("k1", "k2", "text").join(reps, ["k1", "k2"])
                    .dropDuplicates(["k1", "k2", "c1"]).select("c1", "text"), "texts")
    strong = _strongest(pairs)
    sure = written(confirmed(strong, texts, words, percent), "links")
    groups = connected_components(sure)
    root_a = groups.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    root_b = groups.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    open_pairs = (pairs.join(strong, ["a", "b"], "left_anti")
                  .join(root_a, "a", "left").join(root_b, "b", "left")
                  .filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")))
    more = written(confirmed(open_pairs, texts, words, percent), "links")
    joined = sure.union(more)
    groups = connected_components(joined)
    if not dense.isEmpty():
        roots = groups.select(F.col("node").alias("c1"), "root")
        crowded = (texts.join(dense, "c1").join(roots, "c1", "left")
                   .select("c1", F.coalesce("root", "c1").alias("root"), "text"))
        last = written(links_between_groups(crowded, words, percent), "last-pairs")
        last = written(confirmed(last, texts, words, percent), "links")
        if not last.isEmpty():
            groups = connected_components(joined.union(last))
    member = (classes.select(F.col("c1").alias("node"), "min_doc").join(groups, "node", "left")
              .select("node", "min_doc", F.coalesce("root", "node").alias("root")))
    # written, so that the join below deals its sides out by itself and can split a large component
    smallest = written(member.groupBy("root").agg(F.min("min_doc").alias("component_id")), "smallest")
    named = member.join(smallest, "root").select(F.col("node").alias("c1"), "root", "component_id")
    return (signed.join(named, "c1", "left")
            .select("k1", "k2", "doc_id", "n_shingles", F.col("root").alias("component"),
                    F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
                    .alias("component_id")))


def keep_one_of_each_group(docs: DataFrame, words: int = 5, percent: int = 80, forest: Forest = Forest()) -> DataFrame:
    """``docs`` with all its columns, one row of each group of near duplicates: that of the smallest doc_id.

    Ties (equal or null ids) go to the smaller hash of id and text; of fully
    repeated rows one stays. Rows without a word belong to no group and all stay.
    """
    groups = near_duplicate_groups(docs, words, percent, forest)
    kept = (groups.filter("component is not null").groupBy("component")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")).alias("kept")))
    key = {c: internal(docs, c) for c in ("k1", "k2")}
    kept = written(kept.select("kept.k1", "kept.k2"), "kept").withColumnsRenamed(key)
    has_word = F.coalesce(F.col("text").rlike("[^ \\t-\\r]"), F.lit(False))
    k1, k2 = row_keys(F.col("doc_id").cast("long"), F.col("text"))
    grouped = (docs.filter(has_word).withColumns({key["k1"]: k1, key["k2"]: k2})
               .join(kept, list(key.values()), "left_semi").dropDuplicates(list(key.values())))
    return grouped.select(*[F.col(f"`{c}`") for c in docs.columns]).union(docs.filter(~has_word))


def _strongest(pairs: DataFrame) -> DataFrame:
    """For each class its most found candidate and its most found region head, as pairs a < b."""
    ends = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "votes", "hub_votes"))
    best = ends.groupBy("a").agg(
        F.max_by("b", F.struct("votes", "hub_votes", "b")).alias("near"),
        F.max_by("b", F.struct("hub_votes", "votes", "b")).alias("head"))
    chosen = best.select("a", F.explode(F.array_distinct(F.array("near", "head"))).alias("b"))
    return chosen.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
