"""Queries for scans, lookups, search and feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import DEFAULT_ROOT_NAME
from ..operators import browse, canvas, lint
from ..session import shared_path
from ..sources.flowdocs import read_flow_docs, write_estate_docs
from ..sources.tables import Estate
from .lint_queries import COUNTS
from .lint_queries import lint_report_sql as _lint_report_sql
from .registry import nullable_as_double, query

PROC_COLS = ["id", "group_id", "name", "type", "run_status", "version", "validation_errors"]


def _flat_processors(df):
    """Processors with the error list as ';'-joined text (comparable to the fixture)."""
    return df.select(*[F.array_join("validation_errors", ";").alias(c) if c == "validation_errors" else c
                       for c in PROC_COLS])


# --- B1 ---------------------------------------------------------------------

@query("root_group", ["fx_group"], f"""
SELECT id AS root_id, coalesce(name, '{DEFAULT_ROOT_NAME}') AS name, parent_id AS parent_group_id
FROM fx_group WHERE parent_id IS NULL""")
def q_root_group(spark, sf_dir):
    """B1: the root group of the group table."""
    return browse.root_group(Estate.load(spark, sf_dir).groups)


# --- B2-B5 --------------------------------------------------------------------

@query("group_processors", ["fx_processor"], """
SELECT id, group_id, name, type, run_status, version, validation_errors FROM fx_processor WHERE group_id = 'pg-n7'""")
def q_group_processors(spark, sf_dir):
    """B2: processors of group pg-n7."""
    return _flat_processors(browse.group_processors(Estate.load(spark, sf_dir).processors, ["pg-n7"]))


@query("group_connections", ["fx_connection"], """
SELECT * FROM fx_connection WHERE group_id = 'pg-n7'""")
def q_group_connections(spark, sf_dir):
    """Connections of group pg-n7."""
    return browse.group_connections(Estate.load(spark, sf_dir).connections, ["pg-n7"])


@query("group_children", ["fx_group"], """
SELECT * FROM fx_group WHERE parent_id = 'pg-r2'""")
def q_group_children(spark, sf_dir):
    """Immediate children of pg-r2."""
    return browse.group_children(Estate.load(spark, sf_dir).groups, ["pg-r2"])


@query("group_ports", ["fx_port"], """
SELECT * FROM fx_port WHERE group_id = 'pg-n7'""")
def q_group_ports(spark, sf_dir):
    """Input and output ports of pg-n7."""
    return browse.group_ports(Estate.load(spark, sf_dir).ports, ["pg-n7"])


# --- B6 -----------------------------------------------------------------------

@query("entity_lookup", ["fx_processor"], """
, req(requested_id) AS (VALUES ('proc-s3'), ('proc-c46'), ('proc-none'))
SELECT r.requested_id, p.id IS NOT NULL AS found, p.id, p.group_id, p.name, p.type, p.run_status,
  CAST(p.version AS DOUBLE) AS version, p.validation_errors
FROM req r LEFT JOIN fx_processor p ON p.id = r.requested_id""")
def q_entity_lookup(spark, sf_dir):
    """Processor details by id; unknown ids reported with found = false."""
    procs = _flat_processors(Estate.load(spark, sf_dir).processors)
    return nullable_as_double(browse.entity_lookup(spark, procs, ["proc-s3", "proc-c46", "proc-none"]), "version")


# --- B7 -----------------------------------------------------------------------

@query("processor_type_catalog", ["fx_processor_type"], """
SELECT DISTINCT type, bundle, coalesce(description, '') AS description, coalesce(tags, '') AS tags
FROM fx_processor_type""")
def q_processor_type_catalog(spark, sf_dir):
    """Processor types with defaults for description and tags."""
    return browse.processor_type_catalog(Estate.load(spark, sf_dir).processor_types)


# --- B8 -----------------------------------------------------------------------

def _search_sql(q: str) -> str:
    ql = q.lower().replace("'", "''")

    def hit(c):
        return f"coalesce(instr(lower({c}), '{ql}') > 0, false)"

    def part(kind, table, fields, name="name"):
        tags = ", ".join(f"CASE WHEN {hit(c)} THEN '{c}' END" for c in fields)
        cond = " OR ".join(hit(c) for c in fields)
        return (f"SELECT '{kind}' AS kind, id, {name} AS name, concat_ws(',', {tags}) AS matched_on "
                f"FROM {table} WHERE {cond}")

    return "\nUNION ALL ".join([
        part("processor", "fx_processor", ["id", "name", "type"]),
        part("connection", "fx_connection", ["id"], "CAST(NULL AS VARCHAR)"),
        part("group", "fx_group", ["id", "name"]),
        part("port", "fx_port", ["id", "name"]),
    ])


def _search(spark, sf_dir, q):
    e = Estate.load(spark, sf_dir)
    return browse.component_search(
        q, processor=e.processors.select("id", "name", "type"), connection=e.connections.select("id"),
        group=e.groups.select("id", "name"), port=e.ports.select("id", "name"))


_SEARCH_VIEWS = ["fx_processor", "fx_connection", "fx_group", "fx_port"]


@query("component_search", _SEARCH_VIEWS, _search_sql("ier#00000000"))
def q_component_search(spark, sf_dir):
    """Case-insensitive literal search for 'ier#00000000' over every component kind."""
    return _search(spark, sf_dir, "ier#00000000")


@query("component_search_literal", _SEARCH_VIEWS, _search_sql("%"))
def q_component_search_literal(spark, sf_dir):
    """B8: '%' is matched literally (no LIKE wildcard), so nothing matches."""
    return _search(spark, sf_dir, "%")


# --- B9 -----------------------------------------------------------------------

def _feed_sql(where: str) -> str:
    return f"SELECT * FROM fx_bulletin WHERE {where} ORDER BY ts DESC, id DESC LIMIT 100"


@query("bulletin_feed_group", ["fx_bulletin"], _feed_sql("group_id = 'pg-n7'"))
def q_bulletin_feed_group(spark, sf_dir):
    """Newest 100 bulletins of group pg-n7."""
    return browse.bulletin_feed(Estate.load(spark, sf_dir).bulletins, group_id="pg-n7")


@query("bulletin_feed_source", ["fx_bulletin"], _feed_sql("source_id = 'proc-c46'"))
def q_bulletin_feed_source(spark, sf_dir):
    """Newest 100 bulletins of source proc-c46."""
    return browse.bulletin_feed(Estate.load(spark, sf_dir).bulletins, source_id="proc-c46")


@query("bulletin_feed_both", ["fx_bulletin"], _feed_sql("group_id = 'pg-n11' AND source_id = 'proc-c46'"))
def q_bulletin_feed_both(spark, sf_dir):
    """Both filters (AND): group pg-n11 and source proc-c46."""
    return browse.bulletin_feed(Estate.load(spark, sf_dir).bulletins, group_id="pg-n11", source_id="proc-c46")


# --- B10 ----------------------------------------------------------------------

@query("queue_listing", ["fx_queue"], """
SELECT connection_id, group_id, flowfile_uuid, size_bytes, queued_at,
  row_number() OVER (PARTITION BY connection_id ORDER BY queued_at, flowfile_uuid, size_bytes) AS position
FROM fx_queue""")
def q_queue_listing(spark, sf_dir):
    """Every queued item with its position in its connection's queue."""
    return browse.queue_listing(Estate.load(spark, sf_dir).queue)


@query("queue_listing_connection", ["fx_queue"], """
SELECT connection_id, group_id, flowfile_uuid, size_bytes, queued_at,
  row_number() OVER (PARTITION BY connection_id ORDER BY queued_at, flowfile_uuid, size_bytes) AS position
FROM fx_queue WHERE connection_id IN ('conn-79-952', 'conn-8-45')""")
def q_queue_listing_connection(spark, sf_dir):
    """B10 for given connections (the filter reaches the scan before positions are numbered)."""
    return browse.queue_listing(Estate.load(spark, sf_dir).queue, ["conn-79-952", "conn-8-45"])


# --- A1, A2, D5 (flow documents, JSON round trip) --------------------------------

def _docs_path(spark, sf_dir):
    e = Estate.load(spark, sf_dir)
    path = shared_path(spark, "flowdocs")
    e.fx.keep("fx_connection")  # the shuffles that it takes go before documents are made
    write_estate_docs(path, e.groups, e.processors, e.connections, e.ports, e.funnels, e.labels)
    e.fx.discard("fx_connection")
    return path


def _docs(spark, sf_dir):
    return read_flow_docs(spark, _docs_path(spark, sf_dir))


@query("read_flow_docs", ["fx_group"], "SELECT id, parent_id, name FROM fx_group")
def q_read_flow_docs(spark, sf_dir):
    """A1: flow documents written as JSON and read back with the explicit schema."""
    return canvas.document_groups(_docs(spark, sf_dir))


@query("canvas_processors", ["fx_processor"], """
SELECT id, group_id, name, type, run_status, version, validation_errors FROM fx_processor""")
def q_canvas_processors(spark, sf_dir):
    """A2: processors exploded from the flow documents equal the flat table."""
    return _flat_processors(canvas.canvas_explode(_docs(spark, sf_dir))["processors"])


@query("canvas_connections", ["fx_connection"], """
SELECT id, group_id, source_id, destination_id, bp_objects, bp_size, expiration FROM fx_connection""")
def q_canvas_connections(spark, sf_dir):
    """A2: connections exploded from the flow documents equal the flat table."""
    c = canvas.canvas_explode(_docs(spark, sf_dir))["connections"]
    return c.select("id", "group_id", "source_id", "destination_id", "bp_objects", "bp_size", "expiration")


@query("canvas_process_groups", ["fx_group"], """
SELECT id, parent_id, name FROM fx_group WHERE parent_id IS NOT NULL""")
def q_canvas_process_groups(spark, sf_dir):
    """A2: child groups exploded from the flow documents equal the flat table."""
    return canvas.canvas_explode(_docs(spark, sf_dir))["processGroups"]


@query("canvas_input_ports", ["fx_port"], "SELECT * FROM fx_port WHERE kind = 'INPUT_PORT'")
def q_canvas_input_ports(spark, sf_dir):
    """A2: input ports exploded from the flow documents equal the flat table."""
    return canvas.canvas_explode(_docs(spark, sf_dir))["inputPorts"]


@query("canvas_output_ports", ["fx_port"], "SELECT * FROM fx_port WHERE kind = 'OUTPUT_PORT'")
def q_canvas_output_ports(spark, sf_dir):
    """A2: output ports exploded from the flow documents equal the flat table."""
    return canvas.canvas_explode(_docs(spark, sf_dir))["outputPorts"]


@query("canvas_funnels", ["fx_funnel"], "SELECT id, group_id FROM fx_funnel")
def q_canvas_funnels(spark, sf_dir):
    """A2: funnels exploded from the flow documents equal the flat table."""
    return canvas.canvas_explode(_docs(spark, sf_dir))["funnels"]


@query("canvas_labels", ["fx_label"], "SELECT id, group_id FROM fx_label")
def q_canvas_labels(spark, sf_dir):
    """A2: labels exploded from the flow documents equal the flat table."""
    return canvas.canvas_explode(_docs(spark, sf_dir))["labels"]


@query("flow_counts", ["fx_group", "fx_processor", "fx_connection", "fx_port", "fx_funnel", "fx_label"], """
SELECT g.id AS group_id,
  CAST((SELECT COUNT(*) FROM fx_processor p WHERE p.group_id = g.id) AS BIGINT) AS n_processors,
  CAST((SELECT COUNT(*) FROM fx_connection c WHERE c.group_id = g.id) AS BIGINT) AS n_connections,
  CAST((SELECT COUNT(*) FROM fx_group k WHERE k.parent_id = g.id) AS BIGINT) AS n_process_groups,
  CAST((SELECT COUNT(*) FROM fx_port t WHERE t.group_id = g.id AND t.kind = 'INPUT_PORT') AS BIGINT) AS n_input_ports,
  CAST((SELECT COUNT(*) FROM fx_port t WHERE t.group_id = g.id AND t.kind = 'OUTPUT_PORT') AS BIGINT) AS n_output_ports,
  CAST((SELECT COUNT(*) FROM fx_funnel f WHERE f.group_id = g.id) AS BIGINT) AS n_funnels,
  CAST((SELECT COUNT(*) FROM fx_label l WHERE l.group_id = g.id) AS BIGINT) AS n_labels
FROM fx_group g""")
def q_flow_counts(spark, sf_dir):
    """Entries per member kind in each flow document (missing list = 0)."""
    return canvas.flow_counts(_docs(spark, sf_dir))


@query("root_group_doc", ["fx_group"], f"""
SELECT id AS root_id, coalesce(name, '{DEFAULT_ROOT_NAME}') AS name, '/flow/process-groups/' || id AS uri,
  parent_id AS parent_group_id, CAST(NULL AS VARCHAR) AS parameter_context_id
FROM fx_group WHERE parent_id IS NULL""")
def q_root_group_doc(spark, sf_dir):
    """B1 on flow documents: top-level id, else processGroupFlow.id; error if both empty."""
    return canvas.root_from_documents(_docs(spark, sf_dir))


# --- B6 for the other entity kinds --------------------------------------------

@query("connection_lookup", ["fx_connection"], """
, req(requested_id) AS (VALUES ('conn-0-129'), ('conn-0-1047'), ('conn-none'))
SELECT r.requested_id, c.id IS NOT NULL AS found, c.id, c.group_id, c.source_id, c.destination_id,
  CAST(c.bp_objects AS DOUBLE) AS bp_objects, c.bp_size, c.expiration
FROM req r LEFT JOIN fx_connection c ON c.id = r.requested_id""")
def q_connection_lookup(spark, sf_dir):
    """Connection details by id (unknown id reported)."""
    conns = Estate.load(spark, sf_dir).connections
    return nullable_as_double(browse.entity_lookup(spark, conns, ["conn-0-129", "conn-0-1047", "conn-none"]),
                              "bp_objects")


@query("group_lookup", ["fx_group"], """
, req(requested_id) AS (VALUES ('pg-n7'), ('pg-root'), ('pg-none'))
SELECT r.requested_id, g.id IS NOT NULL AS found, g.* FROM req r LEFT JOIN fx_group g ON g.id = r.requested_id""")
def q_group_lookup(spark, sf_dir):
    """Process group details by id (unknown id reported)."""
    return browse.entity_lookup(spark, Estate.load(spark, sf_dir).groups, ["pg-n7", "pg-root", "pg-none"])


@query("port_lookup", ["fx_port"], """
, req(requested_id) AS (VALUES ('in-n3'), ('out-n3'), ('in-none'))
SELECT r.requested_id, t.id IS NOT NULL AS found, t.* FROM req r LEFT JOIN fx_port t ON t.id = r.requested_id""")
def q_port_lookup(spark, sf_dir):
    """Input / output port details by id (unknown id reported)."""
    return browse.entity_lookup(spark, Estate.load(spark, sf_dir).ports, ["in-n3", "out-n3", "in-none"])


@query("provenance_event_lookup", ["fx_provenance"], """
, req(requested_id) AS (VALUES (CAST(7 AS BIGINT)), (CAST(42 AS BIGINT)), (CAST(-1 AS BIGINT)))
SELECT r.requested_id, e.event_id IS NOT NULL AS found, CAST(e.event_id AS DOUBLE) AS event_id, e.event_time,
  e.event_type, e.component_id, e.flowfile_uuid, CAST(e.input_claim AS DOUBLE) AS input_claim,
  CAST(e.output_claim AS DOUBLE) AS output_claim, e.details
FROM req r LEFT JOIN fx_provenance e ON e.event_id = r.requested_id""")
def q_provenance_event_lookup(spark, sf_dir):
    """Provenance events by event id (unknown id reported)."""
    ev = Estate.load(spark, sf_dir).provenance
    out = browse.entity_lookup(spark, ev, [7, 42, -1], key="event_id", id_type="bigint")
    return nullable_as_double(out, "event_id", "input_claim", "output_claim")


# --- the reference's own path: flow documents -> canvas -> lint / pipelines -----

@query("lint_report_doc", ["fx_group", "fx_processor", "fx_connection"], _lint_report_sql())
def q_lint_report_doc(spark, sf_dir):
    """D1 from flow documents: JSON documents read back, exploded (A2), then linted."""
    docs = _docs(spark, sf_dir)
    parts = canvas.canvas_explode(docs)
    return nullable_as_double(
        lint.lint_report(canvas.document_groups(docs), parts["processors"], parts["connections"]), *COUNTS)


@query("pipeline_list_doc", ["fx_group"], """
SELECT id, coalesce(name, 'root') AS name, 'root' AS parent FROM fx_group WHERE parent_id IS NULL
UNION ALL
SELECT g.id, coalesce(g.name, 'ProcessGroup-' || g.id) AS name, coalesce(r.name, 'root') AS parent
FROM fx_group g JOIN fx_group r ON g.parent_id = r.id WHERE r.parent_id IS NULL""")
def q_pipeline_list_doc(spark, sf_dir):
    """E1 from flow documents: root document's group and its child-group list."""
    return canvas.pipeline_list_from_documents(_docs(spark, sf_dir))


@query("lint_documents", ["fx_group", "fx_processor", "fx_connection"], _lint_report_sql())
def q_lint_documents(spark, sf_dir):
    """D1 per flow document with array functions, batch read of the documents."""
    return nullable_as_double(lint.lint_documents(_docs(spark, sf_dir)), *COUNTS)


@query("lint_documents_stream", ["fx_group", "fx_processor", "fx_connection"], _lint_report_sql())
def q_lint_documents_stream(spark, sf_dir):
    """D1 per flow document on a document stream (availableNow drain), documents in parts settled after it."""
    from ..streaming import streams
    path = _docs_path(spark, sf_dir)
    lines = streams.drain(lint.lint_lines(read_flow_docs(spark, path, streaming=True)), "lintdocs")
    return nullable_as_double(lint.lint_settled(lines), *COUNTS)
