"""Ordered batches of deletes that depend on each other (C3 with H2).

``delete_preflight`` judges every command on the state before the batch. Here a
batch is applied in ``seq`` order: a connection deleted at seq 3 makes the
processor at its end deletable at seq 5, and a group can go once its last
member is gone. A command is

* ``no_target`` or ``invalid_kind`` if it names nothing that can be deleted;
* ``not_found`` if its target never was, or was deleted by an earlier command;
* ``conflict`` if the target has another version than expected;
* ``blocked``, with the reasons as of that moment, or
* ``deleted``.

Deletes never change a version and never stop anything, so all that time
changes is which entities are left. For an entity e, let t(e) be the seq of the
command that deletes it (none: never), and b(e) the largest t of what has to go
before it: the connections at a processor or port, the members of a group. Then
t(e) is the smallest seq over b(e) among the commands on e that nothing else
stands against. That is an aggregate and a join per kind, connections first,
then processors and ports, then groups from the leaves up: each round settles
all groups whose child groups are settled. The rounds are at most the height of
the deleted group subtrees, and a group that no command names, or that keeps a
member, ends all groups above it at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, rounds, written, written_in_rounds

KINDS = ("processor", "input_port", "output_port", "connection", "group")
#: join keys of an entity
ENTITY = ["key", "kind", "id"]
#: t of an entity that stays
NEVER = (1 << 63) - 1


def _version(table: DataFrame) -> Column:
    return F.coalesce(F.col("version").cast("bigint"), F.lit(0).cast("bigint")) if "version" in table.columns else F.lit(0).cast("bigint")


def _port_kind() -> Column:
    return F.when(F.col("kind") == "INPUT_PORT", "input_port").otherwise("output_port")


def _key(kind: Column, id_: Column) -> Column:
    """Leads the join keys of entities: sorts compare numbers, not ids that begin alike."""
    return F.xxhash64(kind, id_).alias("key")


def deletable_entities(processors: DataFrame, groups: DataFrame, ports: DataFrame) -> DataFrame:
    """(key, kind, id, version, stopped) of all but connections: what stands against a delete whatever else goes.

    A group is stopped if none of its processors and ports runs. Tables without
    a ``version`` column have version 0. Repeated rows are one entity: stopped
    if any of them is, with the largest version.
    """
    running = (processors.select("group_id", "run_status").unionByName(ports.select("group_id", "run_status"))
               .where(F.col("run_status") == "RUNNING").select(F.col("group_id").alias("id")).distinct())
    stopped = F.coalesce(F.col("run_status") == "STOPPED", F.lit(False))
    parts = [
        processors.select(F.lit("processor").alias("kind"), "id", _version(processors).alias("version"), stopped.alias("stopped")),
        ports.select(_port_kind().alias("kind"), "id", _version(ports).alias("version"), stopped.alias("stopped")),
        groups.withColumn("_v", _version(groups)).join(running.withColumn("_runs", F.lit(True)), "id", "left").select(
            F.lit("group").alias("kind"), "id", F.col("_v").alias("version"), F.col("_runs").isNull().alias("stopped")),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return (union.where(F.col("id").isNotNull()).withColumn("key", _key(F.col("kind"), F.col("id"))).groupBy(*ENTITY)
            .agg(F.max("version").alias("version"), F.max("stopped").alias("stopped")))


def _connections_settled(tries: DataFrame, connections: DataFrame, queue: DataFrame) -> DataFrame:
    """(key, id, version, queued, t) of the connections of ``tries``, which nothing but their own queues hold.

    tries: key, id, seq, expected_version; connections: key, id, version. Queue
    counts are rows of the aggregate over the connections, not a join.
    """
    waiting = queue.where("connection_id is not null").groupBy(F.col("connection_id").alias("id")).agg(F.count(F.lit(1)).alias("queued"))
    there = (connections.where("id is not null").select("key", "id", "version", F.lit(0).cast("bigint").alias("queued"))
             .unionByName(waiting.select(_key(F.lit("connection"), F.col("id")), "id", F.lit(None).cast("bigint").alias("version"), "queued"))
             .groupBy("key", "id").agg(F.max("version").alias("version"), F.max("queued").alias("queued"))
             .where("version is not null"))
    # judged in the aggregate: as a filter the versions would become a join key, and all rows be shuffled once more
    stands = (F.col("queued") == 0) & (F.col("expected_version") == F.col("version"))
    return tries.join(there, ["key", "id"]).groupBy("key", "id").agg(
        F.max("version").alias("version"), F.max("queued").alias("queued"),
        F.coalesce(F.min(F.when(stands, F.col("seq"))), F.lit(NEVER)).alias("t"))


def _settled(tries: DataFrame, bounds: DataFrame) -> DataFrame:
    """(key, kind, id, t) of the entities of ``tries`` (with seq: commands that only b can block); bounds: key, kind, id, b."""
    b = F.coalesce("b", F.lit(-NEVER - 1))
    return (tries.join(bounds, ENTITY, "left").groupBy(*ENTITY)
            .agg(F.coalesce(F.min(F.when(F.col("seq") > b, F.col("seq"))), F.lit(NEVER)).alias("t")))


def _groups_settled(tries: DataFrame, members: DataFrame, groups: DataFrame) -> DataFrame:
    """(id, b, t) of every group that has tries or members; members: (id, b) without child groups."""
    named = tries.select("id").distinct()
    tree = written(groups.where(F.col("parent_id").isNotNull() & F.col("id").isNotNull()).select("id", "parent_id").distinct()
                    .join(named.withColumn("named", F.lit(True)), "id", "left"), "delete-tree")
    children = tree.groupBy(F.col("parent_id").alias("id")).agg(
        F.count(F.when(F.col("named"), 1)).alias("waits"), F.max(F.col("named").isNull()).alias("kept"))
    start = (named.withColumn("tried", F.lit(True)).join(members, "id", "full").join(children, "id", "full").select(
        "id", F.coalesce("tried", F.lit(False)).alias("tried"),
        F.when(F.coalesce("kept", F.lit(False)), NEVER).otherwise(F.coalesce("b", F.lit(-NEVER - 1))).alias("b"),
        F.coalesce("waits", F.lit(0)).alias("waits")))
    open_ = written(start, "delete-groups")
    done, rounds = None, 0
    while True:
        # a member that stays settles a group whatever its child groups do
        ready = open_.where((F.col("waits") <= 0) | (F.col("b") == NEVER) | ~F.col("tried"))
        t = tries.select("id", "seq").join(ready.select("id", "b"), "id").groupBy("id").agg(
            F.min(F.when(F.col("seq") > F.col("b"), F.col("seq"))).alias("t"))
        now = written(ready.join(t, "id", "left").select("id", "b", F.coalesce("t", F.lit(NEVER)).alias("t"), "tried"), "delete-settled")
        if now.isEmpty():
            # parents that name each other in a circle never become empty
            rest = open_.select("id", F.lit(NEVER).alias("b"), F.lit(NEVER).alias("t"))
            return rest if done is None else done.unionByName(rest)
        settled = now.select("id", "b", "t")
        done = settled if done is None else done.unionByName(settled)
        rounds += 1
        if rounds % 16 == 0:  # keeps the plan short
            done = written(done, "delete-settled")
        told = (now.where("tried").select("id", "t").join(tree.select("id", "parent_id"), "id")
                .groupBy(F.col("parent_id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("latest")))
        open_ = written(
            open_.join(now.select("id"), "id", "left_anti").join(told, "id", "left").select(
                "id", "tried", F.greatest("b", F.coalesce("latest", F.col("b"))).alias("b"),
                (F.col("waits") - F.coalesce("n", F.lit(0))).alias("waits")), "delete-groups")


def delete_apply(commands: DataFrame, processors: DataFrame, connections: DataFrame, groups: DataFrame,
                 ports: DataFrame, queue: DataFrame) -> DataFrame:
    """Outcome of every delete of an ordered batch; see the module docstring for the rules.

    ``commands``: seq, kind (one of ``KINDS``), target_id, expected_version.
    Returns these with ``outcome`` and ``reasons`` (array; empty unless
    blocked): ``not_stopped``, ``connected``, ``queue_not_empty``,
    ``not_empty``. Commands of equal seq are judged on what lower ones left;
    repeated ones are one command and share its outcome. A null seq comes
    before all others, a null expected version matches none. Rows of all tables
    without an id are no entities; no commands give no rows.
    """
    stored_cmds = written(commands.select(
        F.col("seq").cast("bigint").alias("seq"), "kind", "target_id",
        F.col("expected_version").cast("bigint").alias("expected_version")), "delete-commands")
    stored = written(connections.select("id", "group_id", "source_id", "destination_id", _version(connections).alias("version")), "delete-connections")
    # keys do not compress: they are made as rows are read
    cmds = stored_cmds.select("*", _key(F.col("kind"), F.col("target_id")))
    connections = stored.select("*", _key(F.lit("connection"), F.col("id")))
    n = rounds(stored_cmds.count() + stored.count())
    if n > 1:
        queue = written(queue.select("connection_id"), "delete-queue")  # each round reads it

    def cut(table, i, key="key"):
        return table if n == 1 else table.where(F.pmod(key, F.lit(n)) == i)

    when = F.coalesce("seq", F.lit(-NEVER))
    linking = F.coalesce(F.col("kind") == "connection", F.lit(False))
    asked = cmds.select("key", "kind", F.col("target_id").alias("id"), when.alias("seq"), "expected_version")

    own = asked.where(linking & F.col("id").isNotNull()).drop("kind")
    queue_key = _key(F.lit("connection"), F.col("connection_id"))
    stored_links = written_in_rounds((
        _connections_settled(cut(own, i), cut(connections, i), cut(queue, i, queue_key)).drop("key") for i in range(n)), "delete-links")
    links = stored_links.select("*", _key(F.lit("connection"), F.col("id")))
    # the latest to go of a component's connections (kinds told apart only by the component's own table) and of a group's
    latest = written_in_rounds((
        cut(connections, i).where("id is not null").join(cut(links, i).select("key", "id", "t"), ["key", "id"], "left").select(
            F.coalesce("t", F.lit(NEVER)).alias("t"), F.explode(F.array(F.struct(F.lit("end").alias("of"), F.col("source_id").alias("id")),
                                   F.struct(F.lit("end").alias("of"), F.col("destination_id").alias("id")),
                                   F.struct(F.lit("group").alias("of"), F.col("group_id").alias("id")))).alias("at"))
        .where("at.id is not null").groupBy("at.of", "at.id").agg(F.max("t").alias("b")) for i in range(n)), "delete-latest")
    if n > 1:
        of_rounds, latest = latest, written(latest.groupBy("of", "id").agg(F.max("b").alias("b")), "delete-latest")
        discard(of_rounds)
    discard(stored)

    entities = written(deletable_entities(processors, groups, ports), "delete-entities")
    tries = written(asked.where(~linking).join(entities, ENTITY)
                    .where("stopped and expected_version = version").select(*ENTITY, "seq"), "delete-tries")
    bounds = written(entities.where("kind <> 'group'").select(*ENTITY).join(latest.where("of = 'end'").select("id", "b"), "id")
                     .select(*ENTITY, "b"), "delete-bounds")
    t_pieces = written(_settled(tries.where("kind <> 'group'"), bounds), "delete-t")

    member = (processors.select("group_id", F.lit("processor").alias("kind"), "id")
              .unionByName(ports.select("group_id", _port_kind().alias("kind"), "id"))
              .where("group_id is not null and id is not null").withColumn("key", _key(F.col("kind"), F.col("id"))))
    members = (member.join(t_pieces, ENTITY, "left").select(F.col("group_id").alias("id"), F.coalesce("t", F.lit(NEVER)).alias("b"))
               .unionByName(latest.where("of = 'group'").select("id", "b")).groupBy("id").agg(F.max("b").alias("b")))
    t_groups = _groups_settled(tries.where("kind = 'group'"), members, groups)

    # what blocks and deletes each entity; entities without commands are not asked about
    group = [_key(F.lit("group"), F.col("id")), F.lit("group").alias("kind"), "id"]
    facts = (entities.join(bounds.unionByName(t_groups.select(*group, "b")), ENTITY, "left")
             .join(t_pieces.unionByName(t_groups.select(*group, "t")), ENTITY, "left")
             .select("key", "kind", F.col("id").alias("target_id"), "version", "stopped", F.lit(0).cast("bigint").alias("queued"), "b", "t"))
    held_links = links.select("key", F.col("id").alias("target_id"), "version", F.lit(True).alias("stopped"), "queued",
                              F.lit(None).cast("bigint").alias("b"), "t")
    told = [cut(cmds, i).where(linking).join(cut(held_links, i), ["key", "target_id"], "left").drop("key") for i in range(n)]
    if n > 1:
        told = [written_in_rounds(told, "delete-told")]
        discard(stored_links)
    known = told[0].unionByName(cmds.where(~linking).join(facts, ["key", "kind", "target_id"], "left").drop("key"))

    there = F.col("version").isNotNull() & (F.coalesce("t", F.lit(NEVER)) >= when)
    held = F.coalesce(F.col("b") >= when, F.lit(False))
    reasons = F.array_compact(F.array(
        F.when(~F.col("stopped"), "not_stopped"), F.when(held & (F.col("kind") != "group"), "connected"),
        F.when(F.col("queued") > 0, "queue_not_empty"), F.when(held & (F.col("kind") == "group"), "not_empty")))
    outcome = (F.when(F.col("target_id").isNull(), "no_target")
               .when(~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False)), "invalid_kind")
               .when(~there, "not_found")
               .when(~F.coalesce(F.col("expected_version") == F.col("version"), F.lit(False)), "conflict")
               .when(F.size(reasons) > 0, "blocked").otherwise("deleted"))
    judged = known.withColumn("outcome", outcome)
    return judged.select("seq", "kind", "target_id", "expected_version", "outcome",
                         F.when(F.col("outcome") == "blocked", reasons).otherwise(F.array().cast("array<string>")).alias("reasons"))


def without_deleted(table: DataFrame, outcomes: DataFrame, *kinds: str) -> DataFrame:
    """The rows of an entity table that a batch has left (``kinds`` are those the table holds)."""
    gone = outcomes.where((F.col("outcome") == "deleted") & F.col("kind").isin(*kinds)).select(F.col("target_id").alias("id")).distinct()
    return table.join(gone, "id", "left_anti")
