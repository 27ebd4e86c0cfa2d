"""Pipeline lint: disconnected, stopped and invalid processors.

Input tables (flat, one row per entity):

* ``processors``: ``id, group_id, name, run_status, validation_errors array<string>``
* ``connections``: ``id, group_id, source_id, destination_id``
* ``groups``: ``id`` (for the "no processors" line)

Every rule is a filter or an anti join on (group_id, id), so each rule shuffles
at most once on a unique key; no rule gathers a group into one task.
``lint_documents`` computes the same report per flow document (one document
is one group as read): ``lint_lines`` with array functions and no shuffle, on
batches or streams, and ``lint_settled`` for the documents that come in parts.

``scope`` names columns that partition the estate (for example
``["snapshot_id"]`` when several snapshots are loaded together): they are added
to every join key and grouping and lead the output columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import written
from .canvas import in_parts, whole_only

# Order of the rules inside one group's report (the reference appends in this order).
RULE_ORDER = {"no_processors": 0, "disconnected": 1, "stopped": 2, "invalid": 3}
# What a part of a document says besides the rules: an endpoint of its connections, its own counts.
ENDPOINT, PART = "endpoint", "part"


def _name(c="name"):
    return F.coalesce(F.col(c), F.lit(T.UNKNOWN_NAME))


def connected_endpoints(connections: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Distinct (scope, group_id, id) of every non-empty connection endpoint.

    One scan of the connections (both ends exploded from one row); partial
    aggregation before the shuffle keeps this at one row per endpoint.
    """
    ends = connections.select(*scope, "group_id",
                              F.explode(F.array("source_id", "destination_id")).alias("id"))
    return ends.where(F.col("id").isNotNull() & (F.col("id") != "")).distinct()


def lint_disconnected(processors: DataFrame, connections: DataFrame,
                      scope: Sequence[str] = ()) -> DataFrame:
    """Processors that are neither source nor destination of a connection of their group.

    A DataFrame ``left_anti`` join, never SQL ``NOT IN`` (a null id in the
    subquery would empty the result).
    """
    edges = connected_endpoints(connections, scope)
    return (
        processors.join(edges, [*scope, "group_id", "id"], "left_anti")
        .select(
            *scope,
            "group_id",
            F.col("id").alias("processor_id"),
            F.lit("disconnected").alias("rule"),
            F.format_string(T.MSG_DISCONNECTED, _name(), F.col("id")).alias("suggestion"),
        )
    )


def lint_stopped(processors: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Processors whose run status is exactly ``STOPPED`` (missing = UNKNOWN)."""
    status = F.coalesce(F.col("run_status"), F.lit(T.UNKNOWN_STATUS))
    return processors.where(status == "STOPPED").select(
        *scope,
        "group_id",
        F.col("id").alias("processor_id"),
        F.lit("stopped").alias("rule"),
        F.format_string(T.MSG_STOPPED, _name()).alias("suggestion"),
    )


def lint_invalid(processors: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Processors with a non-empty validation error list, errors joined by ``', '``."""
    errs = F.col("validation_errors")
    return processors.where(F.coalesce(F.size(errs), F.lit(-1)) > 0).select(
        *scope,
        "group_id",
        F.col("id").alias("processor_id"),
        F.lit("invalid").alias("rule"),
        F.format_string(T.MSG_INVALID, _name(), F.array_join(errs, ", ")).alias("suggestion"),
    )


def lint_report(groups: DataFrame, processors: DataFrame, connections: DataFrame,
                scope: Sequence[str] = ()) -> DataFrame:
    """One row per suggestion for every group, with the group's counts.

    Columns: ``[scope...], group_id, rule, rule_order, processor_id, suggestion,
    processor_count, connection_count``.  Within a group the suggestions sort by
    ``(rule_order, processor_id)``.  A group without processors gets the single
    "no processors" line and null counts.
    """
    scope = list(scope)
    gkey = [*scope, "group_id"]
    proc = processors.select(*scope, "id", "group_id", "name", "run_status", "validation_errors")
    conn = connections.select(*scope, "id", "group_id", "source_id", "destination_id")

    # Per-group counts, aggregated before they meet the suggestion rows (the
    # join is many-to-one on a per-group table, no fan-out).  The processor
    # counts also tell which groups are empty, so that aggregate is planned once
    # and its exchange reused.
    pcount = proc.groupBy(*gkey).agg(F.count(F.lit(1)).alias("processor_count"))
    ccount = conn.groupBy(*gkey).agg(F.count(F.lit(1)).alias("connection_count"))
    counts = pcount.join(ccount, gkey, "left").select(
        *gkey, "processor_count",
        F.coalesce("connection_count", F.lit(0)).cast("bigint").alias("connection_count"))

    empty = groups.select(*scope, F.col("id").alias("group_id")).join(pcount, gkey, "left_anti").select(
        *gkey,
        F.lit(None).cast("string").alias("processor_id"),
        F.lit("no_processors").alias("rule"),
        F.lit(T.MSG_NO_PROCESSORS).alias("suggestion"),
        F.lit(None).cast("bigint").alias("processor_count"),
        F.lit(None).cast("bigint").alias("connection_count"),
    )
    # all three rules in one pass over the processors
    ends = connected_endpoints(conn, scope).withColumn("_end", F.lit(True))
    errs = F.col("validation_errors")

    def hit(rule, cond, message):
        return F.when(cond, F.struct(F.lit(rule).alias("rule"), message.alias("suggestion")))

    hits = F.array_compact(F.array(
        hit("disconnected", F.col("_end").isNull(), F.format_string(T.MSG_DISCONNECTED, _name(), F.col("id"))),
        hit("stopped", F.coalesce(F.col("run_status"), F.lit(T.UNKNOWN_STATUS)) == "STOPPED",
            F.format_string(T.MSG_STOPPED, _name())),
        hit("invalid", F.coalesce(F.size(errs), F.lit(-1)) > 0,
            F.format_string(T.MSG_INVALID, _name(), F.array_join(errs, ", ")))))
    rules = (proc.join(ends, [*gkey, "id"], "left")
             .select(*gkey, F.col("id").alias("processor_id"), F.explode(hits).alias("hit"))
             .select(*gkey, "processor_id", "hit.*").join(counts, gkey, "left"))
    order = F.create_map(*[x for k, v in RULE_ORDER.items() for x in (F.lit(k), F.lit(v))])
    return rules.unionByName(empty).withColumn("rule_order", order[F.col("rule")]).select(
        *gkey, "rule", "rule_order", "processor_id", "suggestion",
        "processor_count", "connection_count",
    )


def lint_documents(docs: DataFrame) -> DataFrame:
    """D1 on flow documents, whole or in parts. Same columns and rows as ``lint_report`` on the flattened tables.

    On a stream of whole documents the result is a stream. The report of a
    document in parts needs all its lines, so a stream of those takes two
    steps: ``lint_lines`` on the stream, ``lint_settled`` on what it wrote.
    """
    if docs.isStreaming:
        return lint_lines(whole_only(docs)).drop("document")
    if "part" not in docs.columns:
        return lint_lines(docs).drop("document")
    return lint_settled(written(lint_lines(docs), "lint-lines"))  # documents are parsed once


def lint_settled(lines: DataFrame) -> DataFrame:
    """The report from all ``lint_lines`` of the documents.

    Those of whole documents are the report. Of documents in parts, a
    processor is disconnected if no part has it as an endpoint: one window by
    document and processor tells, so no document is gathered into one task.
    """
    rows = ["group_id", "rule", "rule_order", "processor_id", "suggestion", "processor_count", "connection_count"]
    whole = lines.where(F.col("document").isNull()).select(*rows)
    parts = lines.where(F.col("document").isNotNull())
    counts = parts.where(F.col("rule") == PART).groupBy("document").agg(
        F.max("group_id").alias("group_id"), F.sum("processor_count").alias("processor_count"),
        F.sum("connection_count").alias("connection_count"))
    none = F.lit(None).cast("bigint")
    empty = counts.where("processor_count = 0").select(
        "group_id", F.lit("no_processors").alias("rule"), F.lit(RULE_ORDER["no_processors"]).alias("rule_order"),
        F.lit(None).cast("string").alias("processor_id"), F.lit(T.MSG_NO_PROCESSORS).alias("suggestion"),
        none.alias("processor_count"), none.alias("connection_count"))
    # no endpoint is null: processors without an id stay disconnected
    connected = F.max(F.col("rule") == ENDPOINT).over(Window.partitionBy("document", "processor_id"))
    found = (parts.where(F.col("rule") != PART).withColumn("connected", connected)
             .where((F.col("rule") != ENDPOINT) & ((F.col("rule") != "disconnected") | ~F.col("connected")))
             .drop("group_id", "processor_count", "connection_count", "connected")
             .join(counts.where("processor_count > 0"), "document").select(*rows))
    return whole.unionByName(found).unionByName(empty)


def lint_lines(docs: DataFrame) -> DataFrame:
    """D1 on flow documents, one line at a time, without any join.

    A line holds one group's processors and connections, so the rules
    run on its arrays with built-in higher-order functions.  A processor is
    looked up among the endpoint ids or among the ids that are no endpoint
    (``array_except``, hash based), whichever are fewer; processors without an
    id or with a repeated one are each reported.  Narrow and stateless, so it
    runs unchanged on a stream of documents.  ``document`` is null for whole
    documents, whose rows are final.  A part of a document says which of its
    processors are not connected by itself, which ids it connects, and its
    counts; ``lint_settled`` makes the report of it.
    """
    part = in_parts(docs)
    document = F.col("part.document") if "part" in docs.columns else F.lit(None).cast("string")
    flow = F.col("processGroupFlow.flow")
    procs = flow.getField("processors")
    conns = flow.getField("connections")
    ids = F.transform(procs, lambda p: p["id"])
    ends = F.filter(F.flatten(F.transform(conns, lambda c: F.array(
        c["component"]["source"]["id"], c["component"]["destination"]["id"]))),
        lambda x: x.isNotNull() & (x != ""))
    ends = F.coalesce(F.array_distinct(ends), F.array().cast("array<string>"))

    def lone(procs, ends, free):
        has = lambda where, p: F.coalesce(F.array_contains(where, p["id"]), F.lit(False))
        return F.when(F.size(free) < F.size(ends), F.filter(procs, lambda p: has(free, p) | p["id"].isNull())).otherwise(
            F.filter(procs, lambda p: ~has(ends, p)))

    # one-element arrays bind a value that the lookups then use many times
    disconnected = F.transform(F.array(ends), lambda e: F.transform(
        F.array(F.array_except(ids, e)), lambda free: lone(procs, e, free)))[0][0]

    def line(rule, pid, text):
        return F.struct(F.lit(rule).alias("rule"), F.lit(RULE_ORDER.get(rule, -1)).alias("rule_order"),
                        pid.alias("processor_id"), text.alias("suggestion"))

    def pname(p):
        return F.coalesce(p["component"].getField("name"), F.lit(T.UNKNOWN_NAME))

    def perrs(p):
        return F.coalesce(p["status"]["validationErrors"], p["component"]["validationErrors"])

    n_procs = F.when(procs.isNull(), F.lit(0)).otherwise(F.size(procs))
    found = F.concat(
        F.transform(disconnected, lambda p: line(
            "disconnected", p["id"], F.format_string(T.MSG_DISCONNECTED, pname(p), p["id"]))),
        F.transform(F.filter(procs, lambda p: F.coalesce(p["status"]["runStatus"], F.lit(T.UNKNOWN_STATUS))
                             == "STOPPED"),
                    lambda p: line("stopped", p["id"], F.format_string(T.MSG_STOPPED, pname(p)))),
        F.transform(F.filter(procs, lambda p: F.coalesce(F.size(perrs(p)), F.lit(-1)) > 0),
                    lambda p: line("invalid", p["id"], F.format_string(
                        T.MSG_INVALID, pname(p), F.array_join(perrs(p), ", ")))))
    nothing = F.lit(None).cast("string")
    has = n_procs > 0
    said = F.when(
        part, F.concat(F.when(has, found).otherwise(F.array()),
                       F.transform(ends, lambda e: line(ENDPOINT, e, nothing)), F.array(line(PART, nothing, nothing)))
    ).when(n_procs == 0, F.array(line("no_processors", nothing, F.lit(T.MSG_NO_PROCESSORS)))).otherwise(found)
    return docs.select(
        document.alias("document"),
        F.col("processGroupFlow.id").alias("group_id"),
        F.when(part | has, n_procs.cast("bigint")).alias("processor_count"),
        F.when(part | has, F.when(conns.isNull(), F.lit(0)).otherwise(F.size(conns)).cast("bigint"))
        .alias("connection_count"),
        F.explode(said).alias("l"),
    ).select("document", "group_id", "l.rule", "l.rule_order", "l.processor_id", "l.suggestion",
             "processor_count", "connection_count")
