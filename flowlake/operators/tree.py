"""Group hierarchy: pipeline list, closure, subtree sums, inherited parameters (E1, E2, D4's roll-up).

Sums over subtrees and nearest definitions need no closure, which has a row for
every group and each of its ancestors: both follow pointers that double their
reach each round, so a round has at most a row per group (or per visible
parameter of a defining group) and the rounds are logarithmic in the depth.

The closure is built by doubling: from each group's ancestors nearer than 2**k
and the table of jumps 2**k levels up follow those nearer than 2**(k+1), so a
tree of any depth takes a logarithmic number of joins, and there is no limit on
rows or levels. Jump tables, and deeper closures, are written to the shared
folder to cut the lineage. A cycle in parent links never runs out of jumps; it
is told by a jump longer than there are groups. Only the group tree is walked
this way; connections may be cyclic and nothing here follows them transitively.

``scope`` (for example ``["snapshot_id"]``) keeps trees of different snapshots
apart: its columns join every step and lead the output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

ROOT_PARENT = "root"
CHILD_NAME_PREFIX = "ProcessGroup-"
#: Rounds whose closure stays a plan of joins; later ones start from a written table.
PLAIN_ROUNDS = 2


def group_closure(groups: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """([scope...], ancestor, descendant, distance) for every group, itself at distance 0.

    Raises ``ValueError`` if parent links form a cycle.
    """
    scope = list(scope)
    ids = groups.select(*scope, "id")
    parents = ids.withColumnRenamed("id", "up")
    jump = written(groups.where(F.col("parent_id").isNotNull())
                    .select(*scope, "id", F.col("parent_id").alias("up"))
                    .join(parents, [*scope, "up"], "left_semi").select(*scope, "id", "up"), "jump")
    closure = ids.select(*scope, F.col("id").alias("ancestor"), F.col("id").alias("descendant"),
                         F.lit(0).alias("distance"))
    n, k = None, 0
    while not jump.isEmpty():
        if k >= PLAIN_ROUNDS:
            n = ids.count() if n is None else n
            if 2 ** k > n:
                raise ValueError("the parent links of the groups form a cycle")
        farther = closure.join(jump.withColumnRenamed("id", "ancestor"), [*scope, "ancestor"]).select(
            *scope, F.col("up").alias("ancestor"), "descendant", (F.col("distance") + 2 ** k).alias("distance"))
        closure = closure.unionByName(farther)
        if k >= PLAIN_ROUNDS:
            closure = written(closure, "closure")
        step = jump.select(*scope, F.col("id").alias("up"), F.col("up").alias("top"))
        jump = written(jump.join(step, [*scope, "up"]).select(*scope, "id", F.col("top").alias("up")), "jump")
        k += 1
    return closure


def pipeline_list(groups: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """The root and its immediate children as (id, name, parent name).

    The root's parent is ``root``; a child without a name is
    ``ProcessGroup-<id>``.  (One level, like the tool it mirrors; see
    ``pipeline_tree`` for every level.)
    """
    scope = list(scope)
    root = groups.where(F.col("parent_id").isNull()).select(
        *scope, F.col("id").alias("parent_id"), F.coalesce("name", F.lit(ROOT_PARENT)).alias("root_name"))
    top = root.select(*scope, F.col("parent_id").alias("id"), F.col("root_name").alias("name"),
                      F.lit(ROOT_PARENT).alias("parent"))
    kids = groups.join(root, [*scope, "parent_id"]).select(
        *scope, "id",
        F.coalesce("name", F.concat(F.lit(CHILD_NAME_PREFIX), F.col("id"))).alias("name"),
        F.col("root_name").alias("parent"))
    return top.unionByName(kids)


def pipeline_tree(groups: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """E1, every level: id, name, parent name, depth and the name path from the root.

    Groups that no chain of parents joins to a root give no rows. The names on
    a path are gathered per group: as many as the group is deep.
    """
    scope = list(scope)
    is_root = F.col("parent_id").isNull()
    names = groups.select(*scope, F.col("id").alias("ancestor"), is_root.alias("is_root"), F.coalesce(
        "name", F.when(is_root, F.lit(ROOT_PARENT)).otherwise(F.concat(F.lit(CHILD_NAME_PREFIX), F.col("id"))))
        .alias("name"))
    above = group_closure(groups, scope).join(names, [*scope, "ancestor"])
    paths = above.groupBy(*scope, F.col("descendant").alias("id")).agg(
        F.max("is_root").alias("rooted"), F.sort_array(F.collect_list(F.struct("distance", "name"))).alias("up"))
    path = F.reverse(F.transform("up", lambda x: x["name"]))
    return paths.where("rooted").select(
        *scope, "id", F.col("up")[0]["name"].alias("name"),
        F.coalesce(F.get("up", F.lit(1))["name"], F.lit(ROOT_PARENT)).alias("parent"),
        (F.size("up") - 1).alias("depth"), F.array_join(path, "/").alias("path"))


def _parents(groups: DataFrame, scope: list[str]) -> DataFrame:
    """([scope...], id, up): every group once; up: its parent if that is a group, else null."""
    known = groups.select(*scope, F.col("id").alias("up")).distinct().withColumn("_known", F.lit(True))
    links = groups.select(*scope, "id", F.col("parent_id").alias("up")).join(known, [*scope, "up"], "left")
    return links.groupBy(*scope, "id").agg(F.min(F.when(F.col("_known"), F.col("up"))).alias("up"))


def _told_of_cycle(rounds: int, rows: DataFrame) -> None:
    # pointers that reach farther than there are groups go round
    if rounds > PLAIN_ROUNDS and 2 ** rounds > rows.count():
        raise ValueError("the parent links of the groups form a cycle")


def subtree_sums(groups: DataFrame, own: DataFrame, sums: Sequence[str], scope: Sequence[str] = ()) -> DataFrame:
    """([scope...], id, sums...): each column of ``own`` (by id, one row a group) over the group and all below it.

    After round k a group holds the sums of what is fewer than 2**k levels
    below it and knows its ancestor 2**k levels up, to which it then adds them.
    Raises ``ValueError`` if parent links form a cycle.
    """
    scope = list(scope)
    key = [*scope, "id"]
    state = written(_parents(groups, scope).join(own.select(*key, *sums), key, "left")
                     .select(*key, "up", *[F.coalesce(m, F.lit(0).cast("bigint")).cast("bigint").alias(m) for m in sums]), "subtree")
    rounds = 0
    while not (climbing := state.where("up is not null")).isEmpty():
        _told_of_cycle(rounds, state)
        added = climbing.groupBy(*scope, F.col("up").alias("id")).agg(*[F.sum(m).alias(f"_{m}") for m in sums])
        farther = climbing.select(*scope, F.col("id").alias("up"), F.col("up").alias("_up"))
        state = written(
            state.join(added, key, "left").join(farther, [*scope, "up"], "left").select(
                *key, F.col("_up").alias("up"),
                *[(F.col(m) + F.coalesce(f"_{m}", F.lit(0))).cast("bigint").alias(m) for m in sums]), "subtree")
        rounds += 1
    return state.drop("up")


def nearest_marked(groups: DataFrame, marked: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """([scope...], id, near, distance): the nearest group of ``marked`` (by id) among each group and its ancestors.

    Pointer jumping that ends at marks: a group that has not met one takes over
    the pointer of the group it points to. Groups without a marked ancestor
    give no rows. Raises ``ValueError`` on a cycle of groups without a mark.
    """
    scope = list(scope)
    key = [*scope, "id"]
    parents = _parents(groups, scope).join(marked.select(*key).distinct().withColumn("_mark", F.lit(True)), key, "left")
    state = written(parents.where("_mark or up is not null").select(
        *key, F.when(F.col("_mark"), F.col("id")).otherwise(F.col("up")).alias("near"),
        F.when(F.col("_mark"), 0).otherwise(1).cast("bigint").alias("distance"),
        F.coalesce("_mark", F.lit(False)).alias("met")), "nearest")
    done, rounds = state.where("met"), 0
    while not (walking := state.where("not met")).isEmpty():
        _told_of_cycle(rounds, groups)
        there = done.unionByName(walking).select(*scope, F.col("id").alias("near"), F.col("near").alias("_near"),
                                                 F.col("distance").alias("_distance"), F.col("met").alias("_met"))
        state = written(walking.drop("met").join(there, [*scope, "near"]).select(
            *key, F.col("_near").alias("near"), (F.col("distance") + F.col("_distance")).alias("distance"),
            F.col("_met").alias("met")), "nearest")
        done = done.unionByName(state.where("met"))
        rounds += 1
    return done.drop("met")


def effective_parameters(groups: DataFrame, parameters: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Parameters visible to each group; the nearest definition wins.

    Only groups that define something take part in inheritance: each group is
    pointed to the nearest such group, and these, a tree of their own, inherit
    by doubling: after round k a group has what is defined fewer than 2**k
    defining ancestors up. No closure is built, and a group with many inherited
    parameters is never gathered. Of several values of one name in one group,
    the smallest counts. Groups that see no parameter give no rows. Raises
    ``ValueError`` if parent links form a cycle.
    """
    scope = list(scope)
    key = [*scope, "id"]
    best = F.min(F.struct("distance", "value", "defined_in")).alias("b")

    def nearest(rows):
        return rows.groupBy(*key, "name").agg(best).select(
            *key, "name", F.col("b.value").alias("value"), F.col("b.defined_in").alias("defined_in"), F.col("b.distance").alias("distance"))

    known = groups.select(*scope, F.col("id").alias("group_id")).distinct()
    seen = written(nearest(parameters.join(known, [*scope, "group_id"], "left_semi").select(
        *scope, F.col("group_id").alias("id"), "name", "value", F.col("group_id").alias("defined_in"),
        F.lit(0).cast("bigint").alias("distance"))), "parameters")
    marked = seen.select(*key).distinct()
    near = nearest_marked(groups, marked, scope)
    # the tree of the defining groups: each one's parent, or the nearest defining group above that
    above = near.select(*scope, F.col("id").alias("up"), F.col("near").alias("to"), (F.col("distance") + 1).alias("far"))
    jump = written(_parents(groups, scope).join(marked, key, "left_semi").join(above, [*scope, "up"])
                    .select(*key, "to", "far"), "parameter-tree")
    rounds = 0
    while not jump.isEmpty():
        _told_of_cycle(rounds, groups)
        inherited = jump.join(seen.withColumnRenamed("id", "to"), [*scope, "to"]).select(
            *key, "name", "value", "defined_in", (F.col("distance") + F.col("far")).alias("distance"))
        seen = written(nearest(seen.unionByName(inherited)), "parameters")
        farther = jump.select(*scope, F.col("id").alias("to"), F.col("to").alias("_to"), F.col("far").alias("_far"))
        jump = written(jump.join(farther, [*scope, "to"]).select(
            *key, F.col("_to").alias("to"), (F.col("far") + F.col("_far")).alias("far")), "parameter-tree")
        rounds += 1
    found = near.withColumnRenamed("distance", "_distance").join(
        seen.withColumnRenamed("id", "near"), [*scope, "near"])
    return found.select(*scope, F.col("id").alias("group_id"), "name", "value", "defined_in",
                        (F.col("distance") + F.col("_distance")).cast("int").alias("distance"))
