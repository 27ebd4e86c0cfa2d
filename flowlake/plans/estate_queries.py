"""Queries for hierarchy, status, provenance, graph and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph, provenance, route, status, tree
from ..session import shared_path
from ..sources.tables import Estate
from ..streaming import batch_sink
from .registry import nullable_as_double, query

# --- E1 -------------------------------------------------------------------------

@query("pipeline_list", ["fx_group"], """
SELECT id, coalesce(name, 'root') AS name, 'root' AS parent FROM fx_group WHERE parent_id IS NULL
UNION ALL
SELECT g.id, coalesce(g.name, 'ProcessGroup-' || g.id) AS name, coalesce(r.name, 'root') AS parent
FROM fx_group g JOIN fx_group r ON g.parent_id = r.id WHERE r.parent_id IS NULL""")
def q_pipeline_list(spark, sf_dir):
    """Root and immediate child groups as (id, name, parent name)."""
    return tree.pipeline_list(Estate.load(spark, sf_dir).groups)


@query("pipeline_tree", ["fx_group"], """
, t(id, name, parent, depth, path) AS (
  SELECT id, coalesce(name, 'root'), 'root', 0, coalesce(name, 'root') FROM fx_group WHERE parent_id IS NULL
  UNION ALL
  SELECT g.id, coalesce(g.name, 'ProcessGroup-' || g.id), t.name, t.depth + 1,
         t.path || '/' || coalesce(g.name, 'ProcessGroup-' || g.id)
  FROM t JOIN fx_group g ON g.parent_id = t.id)
SELECT id, name, parent, CAST(depth AS INTEGER) AS depth, path FROM t""", recursive=True)
def q_pipeline_tree(spark, sf_dir):
    """E1 (every level): id, name, parent name, depth and name path of every group."""
    return tree.pipeline_tree(Estate.load(spark, sf_dir).groups)


_CLOSURE_SQL = """
, clos(ancestor, descendant, distance) AS (
  SELECT id, id, 0 FROM fx_group
  UNION ALL
  SELECT clos.ancestor, g.id, clos.distance + 1 FROM clos JOIN fx_group g ON g.parent_id = clos.descendant)
"""


# --- E2 -------------------------------------------------------------------------

@query("effective_parameters", ["fx_group", "fx_parameter"], _CLOSURE_SQL + """
, ranked AS (
  SELECT c.descendant AS group_id, p.name, p.value, c.ancestor AS defined_in, c.distance,
    row_number() OVER (PARTITION BY c.descendant, p.name ORDER BY c.distance, p.value) AS rn
  FROM clos c JOIN fx_parameter p ON p.group_id = c.ancestor)
SELECT group_id, name, value, defined_in, CAST(distance AS INTEGER) AS distance FROM ranked WHERE rn = 1""",
       recursive=True)
def q_effective_parameters(spark, sf_dir):
    """Parameters visible to every group, inherited included, nearest definition wins."""
    e = Estate.load(spark, sf_dir)
    return tree.effective_parameters(e.groups, e.parameters)


# --- D4 -------------------------------------------------------------------------

_OWN_SQL = """
, p AS (SELECT group_id, COUNT(*) AS processors,
          SUM(CASE WHEN run_status = 'RUNNING' THEN 1 ELSE 0 END) AS running,
          SUM(CASE WHEN run_status = 'STOPPED' THEN 1 ELSE 0 END) AS stopped,
          SUM(CASE WHEN run_status = 'DISABLED' THEN 1 ELSE 0 END) AS disabled,
          SUM(CASE WHEN validation_errors IS NOT NULL AND validation_errors <> '' THEN 1 ELSE 0 END) AS invalid
        FROM fx_processor GROUP BY group_id),
cn AS (SELECT group_id, COUNT(*) AS connections FROM fx_connection GROUP BY group_id),
qu AS (SELECT group_id, COUNT(*) AS queued_items, SUM(size_bytes) AS queued_bytes FROM fx_queue GROUP BY group_id),
own AS (SELECT g.id AS group_id,
   CAST(coalesce(p.processors, 0) AS BIGINT) AS processors, CAST(coalesce(p.running, 0) AS BIGINT) AS running,
   CAST(coalesce(p.stopped, 0) AS BIGINT) AS stopped, CAST(coalesce(p.disabled, 0) AS BIGINT) AS disabled,
   CAST(coalesce(p.invalid, 0) AS BIGINT) AS invalid, CAST(coalesce(cn.connections, 0) AS BIGINT) AS connections,
   CAST(coalesce(qu.queued_items, 0) AS BIGINT) AS queued_items,
   CAST(coalesce(qu.queued_bytes, 0) AS BIGINT) AS queued_bytes
  FROM fx_group g LEFT JOIN p ON p.group_id = g.id LEFT JOIN cn ON cn.group_id = g.id
  LEFT JOIN qu ON qu.group_id = g.id)
"""
_METRICS = status.METRICS


@query("group_status", ["fx_group", "fx_processor", "fx_connection", "fx_queue"], _CLOSURE_SQL + _OWN_SQL + """
, rolled AS (SELECT c.ancestor AS group_id, """ + ", ".join(
    f"CAST(SUM(o.{m}) AS BIGINT) AS total_{m}" for m in _METRICS) + """
  FROM clos c JOIN own o ON o.group_id = c.descendant GROUP BY c.ancestor)
SELECT own.group_id, """ + ", ".join(f"own.{m} AS own_{m}" for m in _METRICS) + ", " + ", ".join(
    f"rolled.total_{m}" for m in _METRICS) + """
FROM own JOIN rolled ON rolled.group_id = own.group_id""", recursive=True)
def q_group_status(spark, sf_dir):
    """Own and subtree-rolled processor states, connections and queue load per group."""
    e = Estate.load(spark, sf_dir)
    return status.group_status(e.groups, e.processors, e.connections, e.queue)


# --- I2, I3 ---------------------------------------------------------------------

_NUM = r"'^\s*([0-9]+(?:\.[0-9]+)?)\s*([A-Za-z]+)\s*$'"


def _size_sql(c: str) -> str:
    unit = f"upper(regexp_extract({c}, {_NUM}, 2))"
    num = f"CAST(regexp_extract({c}, {_NUM}, 1) AS DOUBLE)"
    mult = (f"CASE {unit} WHEN 'B' THEN 1 WHEN 'KB' THEN 1024 WHEN 'MB' THEN 1048576 "
            f"WHEN 'GB' THEN 1073741824 WHEN 'TB' THEN 1099511627776 END")
    return f"CAST({num} * {mult} AS BIGINT)"


def _duration_sql(c: str) -> str:
    unit = f"lower(regexp_extract({c}, {_NUM}, 2))"
    num = f"CAST(regexp_extract({c}, {_NUM}, 1) AS DOUBLE)"
    mult = ("CASE WHEN {u} IN ('ms', 'millis', 'milliseconds') THEN 1 "
            "WHEN {u} IN ('s', 'sec', 'secs', 'second', 'seconds') THEN 1000 "
            "WHEN {u} IN ('m', 'min', 'mins', 'minute', 'minutes') THEN 60000 "
            "WHEN {u} IN ('h', 'hr', 'hrs', 'hour', 'hours') THEN 3600000 "
            "WHEN {u} IN ('d', 'day', 'days') THEN 86400000 "
            "WHEN {u} IN ('w', 'wk', 'week', 'weeks') THEN 604800000 END").format(u=unit)
    return f"CAST({num} * {mult} AS BIGINT)"


@query("backpressure_check", ["fx_connection", "fx_queue"], f"""
, load AS (SELECT connection_id, COUNT(*) AS queued_items, CAST(SUM(size_bytes) AS BIGINT) AS queued_bytes
           FROM fx_queue GROUP BY connection_id),
x AS (SELECT c.id AS connection_id, c.group_id, l.queued_items, l.queued_bytes,
        CAST(coalesce(c.bp_objects, 10000) AS BIGINT) AS bp_objects,
        {_size_sql("coalesce(c.bp_size, '1 GB')")} AS bp_bytes
      FROM fx_connection c JOIN load l ON l.connection_id = c.id)
SELECT *, queued_items >= bp_objects AS over_objects, coalesce(queued_bytes >= bp_bytes, false) AS over_size
FROM x WHERE queued_items >= bp_objects OR coalesce(queued_bytes >= bp_bytes, false)""")
def q_backpressure_check(spark, sf_dir):
    """Connections at or over their back-pressure thresholds."""
    e = Estate.load(spark, sf_dir)
    return status.backpressure_check(e.connections, e.queue)


AS_OF = "1999-06-01 00:00:00"


@query("flowfile_expiry", ["fx_connection", "fx_queue"], f"""
, c AS (SELECT id AS connection_id, {_duration_sql("coalesce(expiration, '0 sec')")} AS expiration_ms FROM fx_connection)
SELECT q.connection_id, q.flowfile_uuid, q.queued_at, c.expiration_ms,
  q.queued_at < TIMESTAMP '{AS_OF}' - to_milliseconds(c.expiration_ms) AS expired
FROM fx_queue q JOIN c ON c.connection_id = q.connection_id WHERE c.expiration_ms > 0""")
def q_flowfile_expiry(spark, sf_dir):
    """Queued items on expiring connections, flagged expired as of 1999-06-01."""
    e = Estate.load(spark, sf_dir)
    return status.flowfile_expiry(e.connections, e.queue, AS_OF)


# --- F1 -------------------------------------------------------------------------

_PROV_COLS = "event_id, event_time, event_type, component_id, flowfile_uuid, input_claim, output_claim"


@query("provenance_search_component", ["fx_provenance"], f"""
SELECT {_PROV_COLS} FROM fx_provenance WHERE component_id = 'proc-c46'
ORDER BY event_time DESC, event_id DESC LIMIT 20""")
def q_provenance_search_component(spark, sf_dir):
    """newest 20 events of component proc-c46 (summarized)."""
    ev = Estate.load(spark, sf_dir).provenance
    return provenance.provenance_search(ev, {"componentId": "proc-c46"}, max_results=20)


@query("provenance_search_dates", ["fx_provenance"], f"""
SELECT {_PROV_COLS} FROM fx_provenance WHERE event_type <> 'ERROR'
  AND event_time >= TIMESTAMP '2024-01-10 12:00:00' AND event_time <= TIMESTAMP '2024-01-20 06:30:00'
ORDER BY event_time DESC, event_id DESC LIMIT 500""")
def q_provenance_search_dates(spark, sf_dir):
    """newest 500 events of ten days that are no errors."""
    ev = Estate.load(spark, sf_dir).provenance
    return provenance.provenance_search(ev, {"event_type": ("ERROR", True)}, max_results=500,
                                        start="2024-01-10 12:00:00", end="2024-01-20 06:30:00")


@query("provenance_search_flowfile", ["fx_provenance"], f"""
SELECT {_PROV_COLS} FROM fx_provenance WHERE flowfile_uuid = 'ff-7'
ORDER BY event_time DESC, event_id DESC LIMIT 1000""")
def q_provenance_search_flowfile(spark, sf_dir):
    """events of flow file ff-7, default cap 1000."""
    ev = Estate.load(spark, sf_dir).provenance
    return provenance.provenance_search(ev, {"flowFileUuid": "ff-7"})


@query("provenance_search_inverse", ["fx_provenance"], f"""
SELECT {_PROV_COLS} FROM fx_provenance WHERE component_id IS DISTINCT FROM 'proc-c46'
ORDER BY event_time DESC, event_id DESC LIMIT 1000""")
def q_provenance_search_inverse(spark, sf_dir):
    """inverse term: newest 1000 events not of component proc-c46."""
    ev = Estate.load(spark, sf_dir).provenance
    return provenance.provenance_search(ev, {"componentId": ("proc-c46", True)}, max_results=1000)


# --- C2 -------------------------------------------------------------------------

@query("provenance_event_content", ["fx_provenance", "fx_content"], """
SELECT e.event_id, 'input' AS direction, e.input_claim AS claim_id, c.claim_id IS NOT NULL AS found, c.body
FROM fx_provenance e LEFT JOIN fx_content c ON c.claim_id = e.input_claim
UNION ALL
SELECT e.event_id, 'output', e.output_claim, c.claim_id IS NOT NULL, c.body
FROM fx_provenance e LEFT JOIN fx_content c ON c.claim_id = e.output_claim""")
def q_provenance_event_content(spark, sf_dir):
    """Every event with its input and its output body."""
    e = Estate.load(spark, sf_dir)
    return provenance.provenance_event_content(e.provenance, e.content, "input").unionByName(
        provenance.provenance_event_content(e.provenance, e.content, "output"))


# --- E3, E4 -----------------------------------------------------------------------

def _components(e: Estate):
    return e.processors.select("id", "group_id", F.lit("PROCESSOR").alias("kind")).unionByName(
        e.ports.select("id", "group_id", "kind"))


@query("component_roles", ["fx_processor", "fx_port", "fx_connection", "fx_connection_rel"], """
, comp AS (SELECT id, group_id, 'PROCESSOR' AS kind FROM fx_processor UNION ALL SELECT id, group_id, kind FROM fx_port),
o AS (SELECT source_id AS id, COUNT(*) AS n FROM fx_connection GROUP BY source_id),
i AS (SELECT destination_id AS id, COUNT(*) AS n FROM fx_connection GROUP BY destination_id),
r AS (SELECT c.source_id AS id, COUNT(DISTINCT r.relationship) AS n
      FROM fx_connection_rel r JOIN fx_connection c ON c.id = r.connection_id GROUP BY c.source_id),
x AS (SELECT comp.id, comp.group_id, comp.kind, CAST(coalesce(o.n, 0) AS BIGINT) AS out_degree,
        CAST(coalesce(i.n, 0) AS BIGINT) AS in_degree, CAST(coalesce(r.n, 0) AS BIGINT) AS out_relationships
      FROM comp LEFT JOIN o ON o.id = comp.id LEFT JOIN i ON i.id = comp.id LEFT JOIN r ON r.id = comp.id)
SELECT *, out_degree > 0 AND in_degree = 0 AS is_source, in_degree > 0 AND out_degree = 0 AS is_destination,
  in_degree > 0 AND out_degree > 0 AS is_transform, out_relationships > 1 AS is_router,
  in_degree = 0 AND out_degree = 0 AS is_unconnected
FROM x""")
def q_component_roles(spark, sf_dir):
    """Degrees and source/destination/transform/router/unconnected flags per component."""
    e = Estate.load(spark, sf_dir)
    return graph.component_roles(_components(e), e.connections, e.connection_relationships)


@query("error_paths", ["fx_connection", "fx_connection_rel", "fx_queue"], """
, f AS (SELECT DISTINCT connection_id FROM fx_connection_rel WHERE relationship = 'failure'),
l AS (SELECT connection_id, COUNT(*) AS n, SUM(size_bytes) AS b FROM fx_queue GROUP BY connection_id)
SELECT c.id AS connection_id, c.group_id, c.source_id, c.destination_id,
  CAST(coalesce(l.n, 0) AS BIGINT) AS queued_items, CAST(coalesce(l.b, 0) AS BIGINT) AS queued_bytes
FROM fx_connection c JOIN f ON f.connection_id = c.id LEFT JOIN l ON l.connection_id = c.id""")
def q_error_paths(spark, sf_dir):
    """Connections carrying 'failure' with their queued load."""
    e = Estate.load(spark, sf_dir)
    return graph.error_paths(e.connections, e.connection_relationships, e.queue)


@query("unrouted_failures", ["fx_processor", "fx_connection", "fx_connection_rel"], """
SELECT p.id, p.group_id, p.name, p.type FROM fx_processor p
WHERE NOT EXISTS (SELECT 1 FROM fx_connection_rel r JOIN fx_connection c ON c.id = r.connection_id
                  WHERE r.relationship = 'failure' AND c.source_id = p.id)""")
def q_unrouted_failures(spark, sf_dir):
    """Processors with no outgoing 'failure' connection (failures go nowhere)."""
    e = Estate.load(spark, sf_dir)
    return graph.unrouted_failures(e.processors, e.connections, e.connection_relationships)


# --- I1 -------------------------------------------------------------------------

@query("relationship_route", [], """
WITH li AS (SELECT * FROM lineitem)
SELECT *, 'success' AS relationship FROM li WHERE l_returnflag = 'A'
UNION ALL SELECT *, 'large' FROM li WHERE l_quantity > 40
UNION ALL SELECT *, 'unmatched' FROM li
  WHERE NOT (coalesce(l_returnflag = 'A', false) OR coalesce(l_quantity > 40, false)
             OR coalesce(l_returnflag = 'R', false))""")
def q_relationship_route(spark, sf_dir):
    """Lineitem rows routed to success / large / failure; failure auto-terminated."""
    return _routed(spark, sf_dir)


def _rules():
    return {"success": F.col("l_returnflag") == "A", "large": F.col("l_quantity") > 40,
            "failure": F.col("l_returnflag") == "R"}


def _routed(spark, sf_dir):
    li = Estate.load(spark, sf_dir).fx.table("lineitem")
    return route.relationship_route(li, _rules(), auto_terminated=["failure"])


_ROUTED_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'success' AS relationship FROM lineitem WHERE l_returnflag = 'A'
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'large' FROM lineitem WHERE l_quantity > 40
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'unmatched' FROM lineitem
  WHERE NOT (coalesce(l_returnflag = 'A', false) OR coalesce(l_quantity > 40, false)
             OR coalesce(l_returnflag = 'R', false))"""


@query("write_by_relationship", [], _ROUTED_SQL)
def q_write_by_relationship(spark, sf_dir):
    """A5: routed lineitem rows written with one directory per relationship, and read back."""
    path = shared_path(spark, "routed")
    route.write_by_relationship(
        _routed(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "relationship"), path)
    return spark.read.parquet(path)


@query("write_stream_batches", [], _ROUTED_SQL)
def q_write_stream_batches(spark, sf_dir):
    """A5 on a stream: routed lineitem rows written by micro-batch ids, and read back."""
    kept = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "relationship"]
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    rows = spark.readStream.schema(li.schema).option("pathGlobFilter", "lineitem*.parquet").parquet(sf_dir)
    routed = route.relationship_route(rows, _rules(), auto_terminated=["failure"]).select(*kept)
    path = shared_path(spark, "routed-batches")
    batch_sink.write_batches(routed, path, shared_path(spark, "routed-ckpt"), ["relationship"]).awaitTermination()
    return batch_sink.read_batches(spark, path, routed.schema)
