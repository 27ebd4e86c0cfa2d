"""Batches of commands checked and applied against versioned tables.

Each operator takes a command table and the current entity tables and returns
one outcome row per command (and, where it applies, the new table).  A command
meets the entity it names through one equi-join on the id; per-entity facts
(endpoints, queue lengths, members) are aggregated to one row per id first.

``scope`` (for example ``["snapshot_id"]``, without nulls) names columns of every
table given; they are added to every join key and grouping and lead the output
columns, so that commands meet their own snapshot only.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import written


def _reasons(*pairs: tuple[Column, str]) -> Column:
    """Array of the reason labels whose condition holds (null condition = no)."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for c, r in pairs]))


# ---------------------------------------------------------------------------
# Delete preflight
# ---------------------------------------------------------------------------

#: Kinds by name: their places are numbers, whose largest one hash aggregates find (that of a text takes sorted rows).
KINDS = ("connection", "group", "input_port", "output_port", "processor")


def delete_facts(processors: DataFrame, connections: DataFrame, groups: DataFrame,
                 ports: DataFrame, queue: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """One row per deletable entity: (kind, id, stopped, connected, queued, members).

    Every table is read once: its rows become what they say about entities (a
    connection: that it exists, that both its ends are connected, that its
    group has a member), and one aggregate by entity, with a map-side partial
    step, puts that together. An id names one entity of its kind: repeated
    rows are one entity, stopped if any of them is.
    """
    def says(about, id_, kind=None, stopped=None, connected=False, queued=0, members=0, running=None):
        return F.struct(
            F.lit(about).alias("about"), id_.alias("id"),
            (kind if isinstance(kind, Column) else F.lit(kind and KINDS.index(kind)).cast("int")).alias("kind"),
            (stopped if isinstance(stopped, Column) else F.lit(stopped).cast("boolean")).alias("stopped"),
            F.lit(connected).alias("connected"), F.lit(queued).cast("bigint").alias("queued"),
            F.lit(members).cast("bigint").alias("members"),
            (running if isinstance(running, Column) else F.lit(False)).alias("running"))

    def rows(df, *facts):
        return df.select(*scope, F.explode(F.array(*facts)).alias("f")).select(*scope, "f.*")

    c, stopped, running = F.col, F.col("run_status") == "STOPPED", F.coalesce(F.col("run_status") == "RUNNING", F.lit(False))
    port_kind = F.when(c("kind") == "INPUT_PORT", KINDS.index("input_port")).otherwise(KINDS.index("output_port"))
    said = rows(processors, says("component", c("id"), "processor", stopped),
                says("group", c("group_id"), members=1, running=running))
    said = said.unionByName(rows(ports, says("component", c("id"), port_kind, stopped),
                                 says("group", c("group_id"), members=1, running=running)))
    said = said.unionByName(rows(connections, says("connection", c("id"), "connection"),
                                 says("component", c("source_id"), connected=True),
                                 says("component", c("destination_id"), connected=True),
                                 says("group", c("group_id"), members=1)))
    said = said.unionByName(rows(groups, says("group", c("id"), "group"),
                                 says("group", c("parent_id"), members=1)))
    said = said.unionByName(rows(queue, says("connection", c("connection_id"), queued=1)))
    facts = said.where(c("id").isNotNull()).groupBy(*scope, "about", "id").agg(
        F.max("kind").alias("kind"), F.max("stopped").alias("stopped"), F.max("connected").alias("connected"),
        F.sum("queued").alias("queued"), F.sum("members").alias("members"), F.max("running").alias("running"))
    return facts.where(c("kind").isNotNull()).select(
        *scope, F.get(F.array(*map(F.lit, KINDS)), c("kind")).alias("kind"), "id",
        F.when(c("about") == "component", c("stopped")).when(c("about") == "group", ~c("running"))
        .otherwise(F.lit(True)).alias("stopped"),
        "connected", "queued", "members")


def delete_preflight(commands: DataFrame, facts: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Which delete commands may proceed, and the reasons for the others.

    processor/port: must be stopped and in no connection; connection: its queue
    must be empty; group: no member (processor, connection, port, child) and
    nothing running.  Reasons are joined with ``', '``.
    """
    f = facts.withColumnRenamed("id", "target_id").withColumn("_found", F.lit(True))
    df = commands.join(f, [*scope, "kind", "target_id"], "left")
    found = F.coalesce(F.col("_found"), F.lit(False))
    reasons = _reasons(
        (~found, "not_found"),
        (found & ~F.coalesce("stopped", F.lit(False)), "not_stopped"),
        (found & F.col("connected"), "has_connections"),
        (found & (F.col("queued") > 0), "queue_not_empty"),
        (found & (F.col("members") > 0), "not_empty"))
    return df.select(*scope, "kind", "target_id", (F.size(reasons) == 0).alias("allowed"),
                     F.array_join(reasons, ", ").alias("reasons"))


# ---------------------------------------------------------------------------
# C4: connection requests
# ---------------------------------------------------------------------------

def connection_validate(requests: DataFrame, components: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """C4: normalise, default and check connection requests.

    Types are upper-cased and must be one of the connectable types; an empty
    name becomes ``Connection from S to D``; thresholds default to 10000 items,
    ``1 GB`` and ``0 sec``.  Both endpoints must exist, have the declared type
    and live in the request's group, which becomes the group of both.  With a
    column ``relationships`` (an array) the selected relationships are carried
    along, and a request without them is invalid; an empty list is a choice.
    """
    carried = [c for c in ("relationships",) if c in requests.columns]
    comp = components.select(*scope, "id", F.col("group_id").alias("_g"), F.col("kind").alias("_k"))
    src = comp.select(*scope, F.col("id").alias("source_id"), F.col("_g").alias("src_group"), F.col("_k").alias("src_kind"))
    dst = comp.select(*scope, F.col("id").alias("destination_id"), F.col("_g").alias("dst_group"),
                      F.col("_k").alias("dst_kind"))
    st = F.upper(F.coalesce("source_type", F.lit("PROCESSOR")))
    dt_ = F.upper(F.coalesce("destination_type", F.lit("PROCESSOR")))
    df = requests.join(src, [*scope, "source_id"], "left").join(dst, [*scope, "destination_id"], "left")
    reasons = _reasons(
        (~st.isin(T.CONNECTABLE_TYPES), "bad_source_type"),
        (~dt_.isin(T.CONNECTABLE_TYPES), "bad_destination_type"),
        (F.col("src_group").isNull(), "source_not_found"),
        (F.col("dst_group").isNull(), "destination_not_found"),
        (F.col("src_group").isNotNull() & (F.col("src_kind") != st), "source_type_mismatch"),
        (F.col("dst_group").isNotNull() & (F.col("dst_kind") != dt_), "destination_type_mismatch"),
        (F.col("src_group") != F.col("group_id"), "source_other_group"),
        (F.col("dst_group") != F.col("group_id"), "destination_other_group"),
        *[(F.col(c).isNull(), "no_relationships") for c in carried])
    name = T.default_text(F.col("name"), F.concat(F.lit("Connection from "), F.col("source_id"),
                                                  F.lit(" to "), F.col("destination_id")))
    return df.select(
        *scope, "request_id", "group_id", "source_id", st.alias("source_type"), F.col("group_id").alias("source_group_id"),
        "destination_id", dt_.alias("destination_type"), F.col("group_id").alias("destination_group_id"),
        name.alias("name"), *carried,
        F.lit(T.DEFAULT_BP_OBJECTS).cast("bigint").alias("bp_objects"),
        F.lit(T.DEFAULT_BP_SIZE).alias("bp_size"), F.lit(T.DEFAULT_EXPIRATION).alias("expiration"),
        (F.size(reasons) == 0).alias("valid"), F.array_join(reasons, ", ").alias("reasons"))


# ---------------------------------------------------------------------------
# H1: pipeline specs
# ---------------------------------------------------------------------------

def pipeline_spec_expand(specs: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """H1: pipeline steps → created / rejected / skipped component rows.

    Input rows: ``pipeline_id, i, type, name, x, y, config`` (one row per step; a
    missing field is null; ``y`` and the map ``config`` may be left out, and a
    null config becomes an empty map).  ``type`` is checked before ``name``.  Steps before
    the first bad one are created, the bad one is rejected with the message,
    the rest are skipped.  Default position ``(200 + 200*i, 200)``.

    The first bad step per pipeline is a grouped ``min`` (partial aggregation),
    joined back many-to-one, so a very long pipeline is not one window task.
    """
    if "y" not in specs.columns:
        specs = specs.withColumn("y", F.lit(None).cast("double"))
    bad = F.col("type").isNull() | F.col("name").isNull()
    key = [*scope, "pipeline_id"]
    first_bad = specs.groupBy(*[F.col(c).alias(f"_key_{c}") for c in key]).agg(
        F.min(F.when(bad, F.col("i"))).alias("first_bad"))
    df = specs.join(first_bad, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in key]))
    fb = F.col("first_bad")
    status = (F.when(fb.isNull() | (F.col("i") < fb), F.lit("created"))
              .when(F.col("i") == fb, F.lit("rejected")).otherwise(F.lit("skipped")))
    missing = F.when(F.col("type").isNull(), F.lit("type")).otherwise(F.lit("name"))
    message = F.when(status == "rejected", F.format_string(T.MSG_MISSING_FIELD, F.col("i").cast("int"), missing))
    return df.select(
        *key, "i", status.alias("status"), message.alias("message"), "type", "name",
        F.coalesce("x", F.lit(200.0) + F.lit(200.0) * F.col("i")).cast("double").alias("x"),
        F.coalesce("y", F.lit(200.0)).cast("double").alias("y"),
        *([F.coalesce("config", F.create_map().cast("map<string,string>")).alias("config")]
          if "config" in specs.columns else []))


def pipeline_summary(expanded: DataFrame, names: DataFrame | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """H1 per pipeline: its group (at the fixed position), steps created, outcome.

    ``expanded`` is the output of ``pipeline_spec_expand``; ``names`` optionally
    maps ``pipeline_id`` to ``name`` (the id is used otherwise); a pipeline that
    is only there has no steps and succeeds with 0 processors.  A pipeline
    with a rejected step is not a success and reports that step's message; the
    group and the steps before it exist anyway (creation is not atomic).  One
    grouped aggregate with a map-side partial step.
    """
    key = [*scope, "pipeline_id"]
    agg = expanded.groupBy(*key).agg(
        F.count_if(F.col("status") == "created").alias("created"),
        F.min(F.when(F.col("status") == "rejected", F.struct("i", "message"))).alias("bad"))
    if names is not None:
        agg = agg.join(names.select(*key, "name"), key, "full").withColumn(
            "created", F.coalesce("created", F.lit(0)))
        name = F.coalesce(F.col("name"), F.col("pipeline_id").cast("string"))
    else:
        name = F.col("pipeline_id").cast("string")
    ok = F.col("bad").isNull()
    return agg.select(
        *key, name.alias("name"),
        F.lit(T.PIPELINE_GROUP_X).alias("x"), F.lit(T.PIPELINE_GROUP_Y).alias("y"),
        F.col("created").cast("bigint").alias("created"), ok.alias("success"),
        F.when(ok, F.format_string(T.MSG_PIPELINE_CREATED, name, F.col("created").cast("int")))
        .otherwise(F.col("bad.message")).alias("message"))


# ---------------------------------------------------------------------------
# H3: processor config updates
# ---------------------------------------------------------------------------

def _last_commands(updates: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """The rows of each processor's last command of each type (highest ``seq``; without one, all rows are one command).

    The updates are read once; what meets itself and every section is a written table.
    """
    key = [*scope, "processor_id", "update_type"]
    rows = written(updates.where(F.col("update_type").isin(T.CONFIG_PROPERTIES, T.CONFIG_AUTO_TERMINATED)).select(
        *(["seq"] if "seq" in updates.columns else []), *key, "name", "value"), "config-updates")
    if "seq" not in updates.columns:
        return rows
    last = rows.groupBy(*key).agg(F.max("seq").alias("seq"))
    return rows.join(last, [*key, "seq"]).select(*key, "name", "value")


def config_update(properties: DataFrame, updates: DataFrame, processors: DataFrame,
                  auto_terminated: DataFrame | None = None, scope: Sequence[str] = ()):
    """H3: apply config updates given as long rows ``([seq,] processor_id, update_type, name, value)``.

    Rows of one ``seq`` are one command; of several commands of one type to one
    processor the last replaces those before.  ``properties`` replaces the
    processor's whole property map with the payload; a row without a name is an
    empty payload.  ``auto-terminatedrelationships`` replaces its list with the
    payload's values; a row without a value is an empty list.  Any other kind is
    rejected, as is an unknown processor; everything else is kept.
    ``auto_terminated`` (``processor_id, value``) is the list before.  Returns
    ``(status, config)``: one status row per (processor_id, update_type), and
    the new long config table ``(processor_id, section, name, value)``.
    """
    key = [*scope, "processor_id"]
    cmds = updates.select(*key, "update_type").distinct()
    known = processors.select(*scope, F.col("id").alias("processor_id"), F.lit(True).alias("_found"))
    ok_kind = F.coalesce(F.col("update_type").isin(T.CONFIG_PROPERTIES, T.CONFIG_AUTO_TERMINATED), F.lit(False))
    status = cmds.join(known, key, "left").select(
        *key, "update_type",
        F.when(~ok_kind, F.lit("invalid_update_type"))
        .when(F.col("_found").isNull(), F.lit("not_found")).otherwise(F.lit("applied")).alias("status"))
    applied = written(_last_commands(updates, scope).join(known.select(*key), key, "left_semi"), "config-applied")

    def section(kind, label, old, name, value, some):
        new = applied.where(F.col("update_type") == kind)
        kept = old.join(new.select(*key).distinct(), key, "left_anti")
        rows = kept.select(*key, name, value).unionByName(new.where(some).select(*key, name, value))
        return rows.select(*key, F.lit(label).alias("section"), "name", "value")

    none = F.lit(None).cast("string").alias("name")
    config = section(T.CONFIG_PROPERTIES, "properties", properties, F.col("name"), F.col("value"),
                     F.col("name").isNotNull())
    old_auto = auto_terminated if auto_terminated is not None else properties.where(F.lit(False))
    return status, config.unionByName(section(T.CONFIG_AUTO_TERMINATED, "autoTerminatedRelationships", old_auto, none,
                                              F.col("value"), F.col("value").isNotNull()))


def config_update_maps(processors: DataFrame, updates: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """H3 on the nested config: ``properties`` (map) and ``auto_terminated`` (list).

    ``processors``: ``id, properties map<string,string>, auto_terminated array<string>``;
    ``updates``: long rows ``([seq,] processor_id, update_type, name, value)``, by the
    rules of ``config_update``; of a name that one payload holds twice the larger
    value stays.  Each last payload is gathered per processor (bounded by that
    command's size) and joined to its processor.
    """
    last = _last_commands(updates, scope)
    is_props = F.col("update_type") == T.CONFIG_PROPERTIES
    entries = last.groupBy(*scope, "processor_id", "update_type", F.when(is_props, F.col("name")).otherwise(F.col("value"))
                           .alias("entry")).agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("times"))
    payload = entries.groupBy(*scope, "processor_id").agg(
        F.map_from_entries(F.collect_list(F.when(is_props & F.col("entry").isNotNull(), F.struct("entry", "value"))))
        .alias("_props"),
        F.max(is_props).alias("_has_props"),
        F.array_sort(F.flatten(F.collect_list(F.when(~is_props & F.col("entry").isNotNull(), F.array_repeat(
            "entry", F.col("times").cast("int")))))).alias("_auto"),
        F.max(~is_props).alias("_has_auto"))
    df = processors.join(payload.withColumnRenamed("processor_id", "id"), [*scope, "id"], "left")
    return df.select(
        *scope, "id",
        F.when(F.coalesce("_has_props", F.lit(False)), F.col("_props")).otherwise(F.col("properties"))
        .alias("properties"),
        F.when(F.coalesce("_has_auto", F.lit(False)), F.col("_auto")).otherwise(F.col("auto_terminated"))
        .alias("auto_terminated"))


# ---------------------------------------------------------------------------
# H4 / H5: run state
# ---------------------------------------------------------------------------

def state_apply(commands: DataFrame, processors: DataFrame, ports: DataFrame | None = None,
                scope: Sequence[str] = ()) -> DataFrame:
    """H4: set run states.  The input is upper-cased, then checked per kind.

    Processors accept RUNNING and STOPPED; ports also DISABLED.  No version is
    needed (ports re-read their revision).  Status: ``set``, ``invalid_state``
    or ``not_found``.  An unknown id is ``not_found`` unless the state is
    invalid for every kind; a missing state is invalid.
    """
    comp = processors.select(*scope, F.col("id").alias("target_id"), F.lit("processor").alias("kind"), "run_status")
    if ports is not None:
        comp = comp.unionByName(ports.select(*scope, F.col("id").alias("target_id"), F.lit("port").alias("kind"), "run_status"))
    st = F.upper(F.col("state"))
    df = commands.join(comp, [*scope, "target_id"], "left")
    any_kind = sorted({*T.PORT_STATES, *T.PROCESSOR_STATES})
    allowed = (F.when(F.col("kind") == "port", st.isin(T.PORT_STATES))
               .when(F.col("kind") == "processor", st.isin(T.PROCESSOR_STATES)).otherwise(st.isin(any_kind)))
    status = (F.when(~F.coalesce(allowed, F.lit(False)), F.lit("invalid_state"))
              .when(F.col("kind").isNull(), F.lit("not_found")).otherwise(F.lit("set")))
    return df.select(
        *scope, "target_id", "kind", st.alias("requested_state"), F.col("run_status").alias("previous_state"),
        status.alias("status"),
        F.when(status == "set", st).otherwise(F.col("run_status")).alias("new_state"))


def group_state_apply(spark, requests: Iterable[tuple[str, str]] | DataFrame, processors: DataFrame,
                      ports: DataFrame | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """H5: set the state of every eligible component of the requested groups.

    ``requests`` is a list of (group_id, state), or a table ``group_id, state,
    seq``; of several requests for a group the last one counts.  State must be
    RUNNING or STOPPED after upper-casing: a list with another one is an error,
    such rows of a table are left out.  Eligible: not DISABLED and no
    validation error (processors; ports have none).  No version check.  A list
    counts for every snapshot of the ``scope``, a table's rows for their own.
    """
    eligible = (F.coalesce(F.col("run_status"), F.lit("")) != "DISABLED") & \
        (F.coalesce(F.size("validation_errors"), F.lit(0)) <= 0)
    members = processors.select(*scope, "id", "group_id", "run_status", "validation_errors")
    if ports is not None:
        members = members.unionByName(ports.select(*scope, "id", "group_id", "run_status"), allowMissingColumns=True)
    key = ["group_id"]
    if isinstance(requests, DataFrame):
        key = [*scope, "group_id"]
        valid = requests.withColumn("state", F.upper("state")).where(F.col("state").isin(T.GROUP_STATES))
        rq = valid.groupBy(*key).agg(F.max_by("state", F.struct("seq", "state")).alias("state"))
    else:
        req = {}
        for g, s in requests:
            req[g] = s.upper()
            if req[g] not in T.GROUP_STATES:
                raise ValueError(f"Invalid state {s!r}: must be one of {T.GROUP_STATES}")
        # as long as the argument
        rq = F.broadcast(spark.createDataFrame(list(req.items()), "group_id string, state string"))
        members = members.where(F.col("group_id").isin(sorted(req)))
    return members.join(rq, key).where(eligible).select(
        *scope, "id", "group_id", F.col("run_status").alias("previous_state"), F.col("state").alias("new_state"))
