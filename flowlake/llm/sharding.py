"""Sharding by balanced label propagation, in DataFrame operations only.

Rows that share a link value are neighbours. Linked rows start dealt out evenly;
in each round every one of them looks at how many neighbours it has in each
shard and asks for the shard with the most. Requests are granted under capacity
quotas: what a shard takes in, less what leaves it, never exceeds its room, so
full shards still exchange rows. The rows that have no neighbours cost nothing
wherever they stand, so they fill what the others leave of each shard's quota;
row counts end at most one apart.

Neighbours are counted per (link value, shard) before they meet the rows again,
and ranks come from bucket counts, so that a link value shared by a third of
all rows is never gathered. The driver sees one number for each pair of shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: rows of one bucket are ranked in one task
BUCKET_ROWS = 50_000
#: requests are granted in the order of their link value in so many buckets, so that neighbours move together
ORDER_LINKS = 256


def ranked(df: DataFrame, keys: list[str], bucket: Column, name: str) -> DataFrame:
    """``df`` with ``name``: each row's place, from 0, among the rows of its keys, by bucket and then rid.

    Two steps, so that no task sees all rows of a key: the counts of the
    buckets give where each begins, and places within a bucket add to that.
    """
    df = df.withColumn("_bucket", bucket)
    counts = df.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*keys).orderBy("_bucket")
    begins = counts.select(*keys, "_bucket", (F.sum("_n").over(upto) - F.col("_n")).alias("_begin"))
    within = Window.partitionBy(*keys, "_bucket").orderBy("rid")
    return (df.join(begins, [*keys, "_bucket"])
            .withColumn(name, F.col("_begin") + F.row_number().over(within) - 1)
            .drop("_bucket", "_begin"))


def hashed(n: int, *cols) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n))


def grants(wishes: dict[tuple[int, int], int], linked: list[int], quota: list[int]) -> dict[tuple[int, int], int]:
    """How many of the wishes (from, to) -> rows can be granted at once within the quotas.

    Two shards exchange as many rows as both sides wish. Of the rest, shards
    that would overflow take back in proportion; as that only ever leaves more
    rows where they are, and granting none of the rest is possible, it ends.
    """
    swaps = {(a, b): min(n, wishes.get((b, a), 0)) for (a, b), n in wishes.items()}
    x = {move: n - swaps[move] for move, n in wishes.items()}
    changed = True
    while changed:
        changed = False
        for s, limit in enumerate(quota):
            coming = sum(n for (_, to), n in x.items() if to == s)
            excess = linked[s] + coming - sum(n for (out, _), n in x.items() if out == s) - limit
            if excess > 0 and coming:
                changed, left = True, coming - excess
                for move in sorted(m for m in x if m[1] == s):
                    # its part of what is left, rounded so that the parts add up
                    part = x[move] * left // max(coming, 1)
                    coming, left, x[move] = coming - x[move], left - part, part
    return {move: n + swaps[move] for move, n in x.items() if n + swaps[move]}


def _votes(state: DataFrame, link: str, shards: int) -> DataFrame:
    """link, n_<link>: array of the rows that share the link value in each shard."""
    cells = state.groupBy(link, "shard").agg(F.count(F.lit(1)).alias("n"))
    by_shard = F.map_from_entries(F.collect_list(F.struct("shard", "n")))  # at most one entry a shard
    return (cells.groupBy(link).agg(by_shard.alias("m"))
            .select(link, F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                                      lambda s: F.coalesce(F.try_element_at("m", s), F.lit(0).cast("long"))).alias(f"n_{link}")))


def _neighbours(state: DataFrame, links: list[str], shards: int) -> DataFrame:
    """``state`` with ``near``: rows that share a link value with each row, itself included, by shard.

    The counts are written first, so that the join is between two plain
    shuffles, of which Spark splits what a hot link value makes large.
    """
    votes = {link: written(_votes(state, link, shards), "shard-votes") for link in links}
    total = None
    for link in links:
        state = state.join(votes[link], link)
        n = F.col(f"n_{link}")
        total = n if total is None else F.zip_with(total, n, lambda a, b: a + b)
    return state.withColumn("near", total).drop(*[f"n_{link}" for link in links])


def _target(links: list[str], shards: int, room: list[int], largest: int) -> Column:
    """The shard with the most neighbours among those that can take the row; ties go where the first link value points.

    A shard can take a row if it has room for all neighbours that stand
    elsewhere, so that a group which does not fit goes on together to the next;
    for groups of more than ``largest`` rows, and links of several kinds, any
    room will do. Without such a shard the row stays.
    """
    rooms = F.array(*[F.lit(n).cast("long") for n in room])
    group = F.aggregate("near", F.lit(0).cast("long"), lambda a, n: a + n)
    small = F.lit(len(links) == 1) & (group <= largest)
    options = F.transform(
        F.col("near"),
        lambda n, s: F.struct(
            F.when(F.when(small, group - n <= F.get(rooms, s)).otherwise((F.get(rooms, s) > 0) | (s == F.col("shard"))), n)
            .when(s == F.col("shard"), -1).otherwise(-2).alias("n"),
            F.pmod(s + F.pmod(F.col(links[0]), F.lit(shards)), F.lit(shards)).alias("turn"),
            s.alias("s")))
    return F.array_max(options).getField("s").cast("int")


def propagate(state: DataFrame, links: list[str], shards: int, quota: list[int], rounds: int) -> DataFrame:
    """(rid, links, shard) after up to ``rounds`` rounds of moves, each row starting in a shard with room for it.

    Shards without room are passed over; once nothing moves any more, a round
    lets all shards exchange rows. Ends when fewer than one row in a thousand
    is exchanged. The driver collects ``shards ** 2`` numbers a round.
    """
    order_rows = max(64, sum(quota) // (BUCKET_ROWS * shards))
    linked = _sizes(state, shards)
    exchange = False
    for _ in range(rounds):
        room = [sum(quota) if exchange else quota[s] - linked[s] for s in range(shards)]
        wanted = written(_neighbours(state, links, shards)
                         .select("rid", *links, "shard", _target(links, shards, room, min(quota)).alias("target")), "shard-wishes")
        cells = wanted.filter("shard != target").groupBy("shard", "target").agg(F.count(F.lit(1)).alias("n")).collect()
        granted = grants({(r.shard, r.target): r.n for r in cells}, linked, quota)
        moves = sum(granted.values())
        if not moves if not exchange else moves <= sum(linked) // 1000:
            if exchange or min(room) > 0:
                break
            exchange = True
            continue
        exchange = False
        moving = ranked(wanted.filter("shard != target"), ["shard", "target"],
                        hashed(ORDER_LINKS, links[0]) * order_rows + hashed(order_rows, "rid"), "place")
        limit = F.array(*[F.lit(granted.get((a, b), 0)).cast("long") for a in range(shards) for b in range(shards)])
        moved = moving.withColumn("to", F.when(
            F.col("place") < F.get(limit, F.col("shard") * shards + F.col("target")), F.col("target")).otherwise(F.col("shard")))
        state = written(wanted.filter("shard = target").select("rid", *links, "shard")
                        .union(moved.select("rid", *links, F.col("to").alias("shard"))), "shard-labels")
        for (out, to), n in granted.items():
            linked[out] -= n
            linked[to] += n
    return state


def _sizes(state: DataFrame, shards: int) -> list[int]:
    counts = {r.shard: r.n for r in state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [counts.get(s, 0) for s in range(shards)]


def balanced_shards(docs: DataFrame, shards: int = 16, link_by: tuple = ("text",), rounds: int = 24) -> DataFrame:
    """Every row's shard, with row counts at most one apart and few links cut.

    link_by: columns or expressions; rows with an equal, non-null value of one
    of them are linked. Returns doc_id, size (UTF-8 bytes of the text plus 1),
    text_crc32, shard, slot (0, 1, ... without gaps in each shard), n_linked
    (other rows that share the row's link values, counted once for each value)
    and n_cut (those of them in other shards). A null text has no bytes; null
    texts are linked with nothing by ``text``. Repeated rows are rows of their
    own and linked if their text is not null. A group with more rows than a
    shard fills as few shards as the rounds reach. No rows give no rows.
    """
    def expression(x):
        return F.col(x) if isinstance(x, str) else x

    links = [f"g{i}" for i in range(len(link_by))]
    # the row number is read back from the written table, so it stays the same from then on
    rows = written(docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))).alias("text_crc32"),
        *[F.when(expression(x).isNotNull(), F.xxhash64(F.lit(i), expression(x))).alias(g)
          for i, (g, x) in enumerate(zip(links, link_by))]), "shard-rows")
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = rows.count()
    buckets = max(8 * partitions, total // BUCKET_ROWS + 1)
    quota = [total // shards + (s < total % shards) for s in range(shards)]

    shared = None  # rows with a neighbour
    for g in links:
        values = written(rows.filter(f"{g} is not null").groupBy(g).agg(F.count(F.lit(1)).alias("n"))
                         .filter("n > 1").select(g), "shard-links")
        found = rows.join(values, g, "left_semi").select("rid", *links)
        shared = found if shared is None else shared.union(found)
    if len(links) > 1:
        # a missing value is made one that no other row has
        shared = shared.distinct().select("rid", *[F.coalesce(g, F.xxhash64("rid", F.lit(g))).alias(g) for g in links])
    shared = written(shared, "shard-linked")
    start = ranked(shared.withColumn("one", F.lit(0)), ["one"], hashed(buckets, "rid"), "place")
    state = written(start.select("rid", *links, F.pmod("place", F.lit(shards)).cast("int").alias("shard")), "shard-labels")
    state = propagate(state, links, shards, quota, rounds)

    counts = _sizes(state, shards)
    filled = [0]
    for s in range(shards):
        filled.append(filled[-1] + quota[s] - counts[s])
    near = (_neighbours(state, links, shards)
            .select("rid", "shard", (F.aggregate("near", F.lit(0).cast("long"), lambda a, n: a + n) - len(links)).alias("n_linked"),
                    (F.get("near", F.col("shard")) - len(links)).alias("n_here")))
    placed = written(rows.select("rid", "doc_id", "size", "text_crc32").join(near, "rid", "left")
                     .withColumn("label", F.coalesce("shard", F.lit(-1))), "shard-placed")
    placed = ranked(placed, ["label"], hashed(buckets, "rid", F.lit(1)), "place")
    ends = F.array(*[F.lit(n).cast("long") for n in filled[1:]])
    filler = F.size(F.filter(ends, lambda end: end <= F.col("place")))
    shard = F.when(F.col("label") >= 0, F.col("label")).otherwise(filler).cast("int")
    own = F.array(*[F.lit(counts[s] - filled[s]).cast("long") for s in range(shards)])
    slot = F.when(F.col("label") >= 0, F.col("place")).otherwise(F.col("place") + F.get(own, filler))
    return placed.select("doc_id", "size", "text_crc32", shard.alias("shard"), slot.alias("slot"),
                         F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
                         F.coalesce(F.col("n_linked") - F.col("n_here"), F.lit(0)).cast("long").alias("n_cut"))
