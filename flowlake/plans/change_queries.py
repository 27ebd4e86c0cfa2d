"""Queries for command batches (C3, C4, H1-H5) and the streams (A3, A4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changes, deletes, versioned
from ..session import shared_path
from ..sources.fixtures import view_over
from ..sources.tables import Estate
from ..streaming import batch_sink, streams
from .registry import nullable_as_double, query, two_snapshots

# --- C3 -------------------------------------------------------------------------

_DELETE_SQL = """
, ends AS (SELECT source_id AS id FROM fx_connection WHERE source_id <> ''
           UNION SELECT destination_id FROM fx_connection WHERE destination_id <> ''),
members AS (
  SELECT group_id AS id, COUNT(*) AS members, SUM(CASE WHEN run_status = 'RUNNING' THEN 1 ELSE 0 END) AS running FROM (
    SELECT group_id, run_status FROM fx_processor UNION ALL SELECT group_id, run_status FROM fx_port
    UNION ALL SELECT group_id, NULL FROM fx_connection UNION ALL SELECT parent_id, NULL FROM fx_group WHERE parent_id IS NOT NULL
  ) m GROUP BY group_id),
qn AS (SELECT connection_id AS id, COUNT(*) AS n FROM fx_queue GROUP BY connection_id),
facts AS (
  SELECT 'processor' AS kind, p.id, p.run_status = 'STOPPED' AS stopped, e.id IS NOT NULL AS connected,
         0 AS queued, 0 AS members FROM fx_processor p LEFT JOIN ends e ON e.id = p.id
  UNION ALL
  SELECT CASE WHEN t.kind = 'INPUT_PORT' THEN 'input_port' ELSE 'output_port' END, t.id, t.run_status = 'STOPPED',
         e.id IS NOT NULL, 0, 0 FROM fx_port t LEFT JOIN ends e ON e.id = t.id
  UNION ALL
  SELECT 'connection', c.id, TRUE, FALSE, coalesce(qn.n, 0), 0 FROM fx_connection c LEFT JOIN qn ON qn.id = c.id
  UNION ALL
  SELECT 'group', g.id, coalesce(m.running, 0) = 0, FALSE, 0, coalesce(m.members, 0)
  FROM fx_group g LEFT JOIN members m ON m.id = g.id),
x AS (
  SELECT d.kind, d.target_id, concat_ws(', ',
    CASE WHEN f.id IS NULL THEN 'not_found' END,
    CASE WHEN f.id IS NOT NULL AND NOT coalesce(f.stopped, false) THEN 'not_stopped' END,
    CASE WHEN f.id IS NOT NULL AND f.connected THEN 'has_connections' END,
    CASE WHEN f.id IS NOT NULL AND f.queued > 0 THEN 'queue_not_empty' END,
    CASE WHEN f.id IS NOT NULL AND f.members > 0 THEN 'not_empty' END) AS reasons
  FROM fx_delete_command d LEFT JOIN facts f ON f.kind = d.kind AND f.id = d.target_id)
SELECT kind, target_id, reasons = '' AS allowed, reasons FROM x"""


@query("delete_preflight", ["fx_delete_command", "fx_processor", "fx_connection", "fx_group", "fx_port",
                            "fx_queue"], _DELETE_SQL)
def q_delete_preflight(spark, sf_dir):
    """Which delete commands may proceed (stopped, unconnected, empty queue, empty group)."""
    e = Estate.load(spark, sf_dir)
    facts = changes.delete_facts(e.processors, e.connections, e.groups, e.ports, e.queue)
    return changes.delete_preflight(e.delete_commands, facts)


# --- C3 with H2: deletes in order -------------------------------------------------

def _delete_apply_sql() -> str:
    never = str(deletes.NEVER)
    # the fixture's groups are four levels deep; each level waits for the one below
    levels = [("l3", "g.id LIKE 'pg-c%'", None), ("l2", "g.id LIKE 'pg-n%' OR g.id LIKE 'pg-e%'", "l3"),
              ("l1", "g.id LIKE 'pg-r%' AND g.id <> 'pg-root'", "l2"), ("l0", "g.id = 'pg-root'", "l1")]
    parts = []
    for name, where, below in levels:
        kids = (f"SELECT x.parent_id AS id, MAX(coalesce(t, {never})) AS b FROM {below} x GROUP BY x.parent_id" if below
                else "SELECT CAST(NULL AS VARCHAR) AS id, CAST(NULL AS BIGINT) AS b WHERE false")
        parts.append(f"""{name} AS (
  SELECT id, parent_id, b, (SELECT MIN(seq) FROM tries WHERE kind = 'group' AND tries.id = y.id AND seq > coalesce(y.b, -1)) AS t
  FROM (SELECT g.id, g.parent_id, greatest(m.b, k.b) AS b FROM fx_group g LEFT JOIN members m ON m.id = g.id
        LEFT JOIN ({kids}) k ON k.id = g.id WHERE {where}) y)""")
    return f"""
, ent AS (
  SELECT 'processor' AS kind, id, version, run_status = 'STOPPED' AS stopped, false AS queued, group_id FROM fx_processor
  UNION ALL SELECT CASE WHEN kind = 'INPUT_PORT' THEN 'input_port' ELSE 'output_port' END, id, 0, run_status = 'STOPPED', false, group_id FROM fx_port
  UNION ALL SELECT 'connection', id, 0, true, id IN (SELECT connection_id FROM fx_late_queue), group_id FROM fx_connection
  UNION ALL SELECT 'group', id, 0, id NOT IN (SELECT group_id FROM fx_processor WHERE run_status = 'RUNNING' UNION SELECT group_id FROM fx_port WHERE run_status = 'RUNNING'),
    false, parent_id FROM fx_group),
tries AS (SELECT d.kind, d.target_id AS id, d.seq FROM fx_delete_batch d JOIN ent e ON e.kind = d.kind AND e.id = d.target_id
          WHERE e.stopped AND NOT e.queued AND e.version = d.expected_version),
tc AS (SELECT id, MIN(seq) AS t FROM tries WHERE kind = 'connection' GROUP BY id),
lasts AS (SELECT x.id, MAX(coalesce(tc.t, {never})) AS b FROM (
    SELECT source_id AS id, id AS c FROM fx_connection UNION ALL SELECT destination_id, id FROM fx_connection) x
  LEFT JOIN tc ON tc.id = x.c GROUP BY x.id),
pieces AS (SELECT e.kind, e.id, l.b FROM ent e LEFT JOIN lasts l ON l.id = e.id WHERE e.kind NOT IN ('group', 'connection')),
tp AS (SELECT p.kind, p.id, MIN(t.seq) AS t FROM pieces p JOIN tries t ON t.kind = p.kind AND t.id = p.id AND t.seq > coalesce(p.b, -1) GROUP BY p.kind, p.id),
members AS (
  SELECT e.group_id AS id, MAX(coalesce(tc.t, tp.t, {never})) AS b FROM ent e LEFT JOIN tc ON e.kind = 'connection' AND tc.id = e.id
    LEFT JOIN tp ON tp.kind = e.kind AND tp.id = e.id WHERE e.kind <> 'group' GROUP BY e.group_id),
{", ".join(parts)},
all_t AS (
  SELECT 'group' AS kind, id, b, t FROM (SELECT * FROM l3 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l0) g
  UNION ALL SELECT p.kind, p.id, p.b, tp.t FROM pieces p LEFT JOIN tp ON tp.kind = p.kind AND tp.id = p.id
  UNION ALL SELECT 'connection', c.id, NULL, tc.t FROM fx_connection c LEFT JOIN tc ON tc.id = c.id),
x AS (
  SELECT d.*, e.id IS NOT NULL AND coalesce(a.t, {never}) >= d.seq AS there, e.version, concat_ws(', ',
      CASE WHEN NOT coalesce(e.stopped, false) THEN 'not_stopped' END, CASE WHEN d.kind <> 'group' AND a.b >= d.seq THEN 'connected' END,
      CASE WHEN e.queued THEN 'queue_not_empty' END, CASE WHEN d.kind = 'group' AND a.b >= d.seq THEN 'not_empty' END) AS why
  FROM fx_delete_batch d LEFT JOIN ent e ON e.kind = d.kind AND e.id = d.target_id LEFT JOIN all_t a ON a.kind = d.kind AND a.id = d.target_id),
y AS (
  SELECT seq, kind, target_id, expected_version, why, CASE WHEN target_id IS NULL THEN 'no_target'
      WHEN kind NOT IN ('processor', 'input_port', 'output_port', 'connection', 'group') THEN 'invalid_kind'
      WHEN NOT there THEN 'not_found' WHEN expected_version <> version THEN 'conflict' WHEN why <> '' THEN 'blocked' ELSE 'deleted' END AS outcome FROM x)
SELECT seq, kind, target_id, expected_version, outcome, CASE WHEN outcome = 'blocked' THEN why ELSE '' END AS reasons FROM y"""


@query("delete_apply", ["fx_delete_batch", "fx_processor", "fx_connection", "fx_group", "fx_port", "fx_late_queue"], _delete_apply_sql())
def q_delete_apply(spark, sf_dir):
    """C3 with H2: an ordered batch of deletes, each on what the ones before it left."""
    e = Estate.load(spark, sf_dir)
    e.fx.keep("fx_transfer")  # the batch, the connections and the queue are views over it
    out = deletes.delete_apply(e.delete_batch, e.processors, e.connections, e.groups, e.ports, e.late_queue)
    return out.withColumn("reasons", F.array_join("reasons", ", "))


# --- C4 -------------------------------------------------------------------------

_TYPES = "('PROCESSOR', 'INPUT_PORT', 'OUTPUT_PORT', 'FUNNEL')"


_CONNECTION_SQL = f"""
, comp AS (SELECT id, group_id, 'PROCESSOR' AS kind FROM fx_processor UNION ALL SELECT id, group_id, kind FROM fx_port),
r AS (SELECT *, upper(coalesce(source_type, 'PROCESSOR')) AS st, upper(coalesce(destination_type, 'PROCESSOR')) AS dt
      FROM fx_connection_request),
x AS (
  SELECT r.request_id, r.group_id, r.source_id, r.st AS source_type, r.destination_id, r.dt AS destination_type,
    coalesce(nullif(r.name, ''), 'Connection from ' || r.source_id || ' to ' || r.destination_id) AS name,
    CAST(10000 AS BIGINT) AS bp_objects, '1 GB' AS bp_size, '0 sec' AS expiration,
    concat_ws(', ',
      CASE WHEN r.st NOT IN {_TYPES} THEN 'bad_source_type' END,
      CASE WHEN r.dt NOT IN {_TYPES} THEN 'bad_destination_type' END,
      CASE WHEN s.id IS NULL THEN 'source_not_found' END,
      CASE WHEN d.id IS NULL THEN 'destination_not_found' END,
      CASE WHEN s.id IS NOT NULL AND s.kind <> r.st THEN 'source_type_mismatch' END,
      CASE WHEN d.id IS NOT NULL AND d.kind <> r.dt THEN 'destination_type_mismatch' END,
      CASE WHEN s.group_id <> r.group_id THEN 'source_other_group' END,
      CASE WHEN d.group_id <> r.group_id THEN 'destination_other_group' END,
      CASE WHEN r.relationships IS NULL THEN 'no_relationships' END) AS reasons,
    r.relationships
  FROM r LEFT JOIN comp s ON s.id = r.source_id LEFT JOIN comp d ON d.id = r.destination_id)
SELECT request_id, group_id, source_id, source_type, group_id AS source_group_id, destination_id, destination_type,
  group_id AS destination_group_id, name, relationships, bp_objects, bp_size, expiration, reasons = '' AS valid, reasons
FROM x"""


@query("connection_validate", ["fx_connection_request", "fx_processor", "fx_port"], _CONNECTION_SQL)
def q_connection_validate(spark, sf_dir):
    """C4: connection requests normalised, defaulted and checked against the components."""
    e = Estate.load(spark, sf_dir)
    comp = e.processors.select("id", "group_id", F.lit("PROCESSOR").alias("kind")).unionByName(
        e.ports.select("id", "group_id", "kind"))
    requests = e.connection_requests.withColumn("relationships", F.split("relationships", ";"))
    return changes.connection_validate(requests, comp).withColumn("relationships", F.array_join("relationships", ";"))


# --- H1 -------------------------------------------------------------------------

_SPEC_SQL = """
, fb AS (SELECT pipeline_id, MIN(CASE WHEN type IS NULL OR name IS NULL THEN i END) AS first_bad
         FROM fx_pipeline_spec GROUP BY pipeline_id),
x AS (SELECT s.*, CASE WHEN fb.first_bad IS NULL OR s.i < fb.first_bad THEN 'created'
                       WHEN s.i = fb.first_bad THEN 'rejected' ELSE 'skipped' END AS status
      FROM fx_pipeline_spec s JOIN fb ON fb.pipeline_id = s.pipeline_id)
SELECT pipeline_id, i, status,
  CASE WHEN status = 'rejected' THEN 'Processor ' || CAST(i AS VARCHAR) || ' missing required '''
       || CASE WHEN type IS NULL THEN 'type' ELSE 'name' END || ''' field' END AS message,
  type, name, CAST(coalesce(x, 200.0 + 200.0 * i) AS DOUBLE) AS x, CAST(200.0 AS DOUBLE) AS y,
  coalesce(config, '') AS config
FROM x"""


@query("pipeline_spec_expand", ["fx_pipeline_spec"], _SPEC_SQL)
def q_pipeline_spec_expand(spark, sf_dir):
    """H1: pipeline specs expanded to created / rejected / skipped steps with default positions and configs."""
    return _as_text(changes.pipeline_spec_expand(_specs(Estate.load(spark, sf_dir))), "config")


def _specs(e: Estate):
    """Pipeline specs with the fixture's ``k=v`` configs as maps."""
    return e.pipeline_specs.withColumn("config", F.expr("str_to_map(config, ';', '=')"))


def _as_text(df, *maps):
    """Maps as ``k=v;...`` text in key order."""
    return df.withColumns({m: F.array_join(F.transform(
        F.array_sort(F.map_entries(m)), lambda kv: F.concat(kv["key"], F.lit("="), kv["value"])), ";") for m in maps})


# --- H2 -------------------------------------------------------------------------

def _step_sql(p: str, v: str, strict=()) -> tuple[str, str, str]:
    missing = "'not_found'"
    if strict:
        ops = ", ".join(f"'{o}'" for o in strict)
        missing = f"CASE WHEN op IN ({ops}) THEN 'error' ELSE 'not_found' END"
    outcome = (f"CASE WHEN op = 'CREATE' THEN CASE WHEN {p} THEN 'exists' ELSE 'created' END "
               f"WHEN op NOT IN ('UPDATE', 'DELETE') THEN 'invalid_op' "
               f"WHEN NOT {p} THEN {missing} "
               f"WHEN expected_version IS NULL OR {v} <> expected_version THEN 'conflict' "
               f"WHEN op = 'DELETE' THEN 'deleted' ELSE 'updated' END")
    pa = (f"CASE WHEN op = 'CREATE' AND NOT {p} THEN TRUE "
          f"WHEN op = 'DELETE' AND {p} AND {v} = expected_version THEN FALSE ELSE {p} END")
    va = (f"CASE WHEN op = 'CREATE' AND NOT {p} THEN CAST(0 AS BIGINT) "
          f"WHEN op = 'DELETE' AND {p} AND {v} = expected_version THEN CAST(NULL AS BIGINT) "
          f"WHEN op = 'UPDATE' AND {p} AND {v} = expected_version THEN {v} + 1 ELSE {v} END")
    return outcome, pa, va


def _versioned_sql(strict=()) -> str:
    o, pa, va = _step_sql("p", "v", strict)
    return f"""
, c AS (SELECT seq, target_id, upper(op) AS op, expected_version,
          row_number() OVER (PARTITION BY target_id ORDER BY seq) AS rn FROM fx_command WHERE target_id IS NOT NULL),
init AS (SELECT id, CAST(0 AS BIGINT) AS version FROM fx_processor),
r(target_id, rn, seq, op, expected_version, outcome, present_after, version_after) AS (
  SELECT target_id, rn, seq, op, expected_version, {o}, {pa}, {va}
  FROM (SELECT c.*, i.id IS NOT NULL AS p, i.version AS v FROM c LEFT JOIN init i ON i.id = c.target_id
        WHERE c.rn = 1) s
  UNION ALL
  SELECT target_id, rn, seq, op, expected_version, {o}, {pa}, {va}
  FROM (SELECT c.*, r.present_after AS p, r.version_after AS v
        FROM r JOIN c ON c.target_id = r.target_id AND c.rn = r.rn + 1) s),
res AS (SELECT seq, target_id, op, expected_version, outcome, present_after, version_after FROM r
  UNION ALL SELECT seq, NULL, upper(op), expected_version, 'no_target', FALSE, NULL FROM fx_command WHERE target_id IS NULL)
"""


_VERSIONED_SQL = _versioned_sql()


def _versioned(spark, sf_dir):
    e = Estate.load(spark, sf_dir)
    initial = e.processors.select("id", F.lit(0).cast("bigint").alias("version"))
    return versioned.versioned_apply(e.commands, initial), initial


@query("versioned_apply", ["fx_command", "fx_processor"], _VERSIONED_SQL + """
SELECT seq, target_id, op, expected_version, outcome, present_after, CAST(version_after AS DOUBLE) AS version_after
FROM res""", recursive=True)
def q_versioned_apply(spark, sf_dir):
    """H2: ordered commands with optimistic locking; every processor starts present at version 0."""
    return nullable_as_double(_versioned(spark, sf_dir)[0], "version_after")


_TABLE_SQL = _VERSIONED_SQL + """
, last AS (SELECT target_id, present_after, version_after,
             row_number() OVER (PARTITION BY target_id ORDER BY rn DESC) AS k FROM r),
since AS (SELECT target_id, max(seq) AS s FROM r WHERE outcome IN ('created', 'deleted') GROUP BY target_id),
payload AS (
  SELECT r.target_id, arg_max(f.config, r.seq) AS config
  FROM r JOIN fx_command f ON f.seq = r.seq LEFT JOIN since ON since.target_id = r.target_id
  WHERE r.outcome IN ('created', 'updated') AND f.config IS NOT NULL AND (since.s IS NULL OR r.seq >= since.s)
  GROUP BY r.target_id)
SELECT id, version, 'initial' AS config FROM init WHERE id NOT IN (SELECT target_id FROM last)
UNION ALL
SELECT last.target_id, last.version_after,
  coalesce(payload.config, CASE WHEN since.s IS NULL THEN 'initial' END)
FROM last LEFT JOIN payload ON payload.target_id = last.target_id LEFT JOIN since ON since.target_id = last.target_id
WHERE k = 1 AND present_after"""


@query("versioned_table", ["fx_command", "fx_processor"], _TABLE_SQL, recursive=True)
def q_versioned_table(spark, sf_dir):
    """H2: the entity table (id, version, config) after the command batch; applied commands write their config."""
    e = Estate.load(spark, sf_dir)
    initial = e.processors.select("id", F.lit(0).cast("bigint").alias("version"), F.lit("initial").alias("config"))
    outcomes = versioned.versioned_apply(e.commands, initial, payload=["config"])
    return versioned.versioned_table(outcomes, initial, payload=["config"])


# --- H3 -------------------------------------------------------------------------

_CONFIG_STATUS_SQL = """
, cmds AS (SELECT DISTINCT processor_id, update_type FROM fx_config_update),
st AS (SELECT c.processor_id, c.update_type,
         CASE WHEN c.update_type NOT IN ('properties', 'auto-terminatedrelationships') THEN 'invalid_update_type'
              WHEN p.id IS NULL THEN 'not_found' ELSE 'applied' END AS status
       FROM cmds c LEFT JOIN fx_processor p ON p.id = c.processor_id)
"""


@query("config_update_status", ["fx_config_update", "fx_processor"], _CONFIG_STATUS_SQL + """
SELECT * FROM st""")
def q_config_update_status(spark, sf_dir):
    """H3: status per config update command (applied / invalid_update_type / not_found)."""
    e = Estate.load(spark, sf_dir)
    return changes.config_update(e.properties, e.config_updates, e.processors)[0]


#: Rows of the last command of each processor and type.
_LAST_CONFIG_SQL = """
, lst AS (SELECT u.* FROM fx_config_update u JOIN (
    SELECT processor_id, update_type, max(seq) AS seq FROM fx_config_update GROUP BY processor_id, update_type) m
  ON m.processor_id = u.processor_id AND m.update_type = u.update_type AND m.seq = u.seq
  JOIN fx_processor p ON p.id = u.processor_id)
"""


_CONFIG_SQL = _LAST_CONFIG_SQL + """
SELECT processor_id, 'properties' AS section, name, value FROM fx_property
  WHERE processor_id NOT IN (SELECT processor_id FROM lst WHERE update_type = 'properties')
UNION ALL SELECT processor_id, 'properties', name, value FROM lst
  WHERE update_type = 'properties' AND name IS NOT NULL
UNION ALL SELECT processor_id, 'autoTerminatedRelationships', CAST(NULL AS VARCHAR), value FROM fx_auto_terminated
  WHERE processor_id NOT IN (SELECT processor_id FROM lst WHERE update_type = 'auto-terminatedrelationships')
UNION ALL SELECT processor_id, 'autoTerminatedRelationships', CAST(NULL AS VARCHAR), value FROM lst
  WHERE update_type = 'auto-terminatedrelationships' AND value IS NOT NULL"""


@query("config_update", ["fx_config_update", "fx_processor", "fx_property", "fx_auto_terminated"], _CONFIG_SQL)
def q_config_update(spark, sf_dir):
    """H3: processor config after the updates (the last payload of each kind replaces what was there)."""
    e = Estate.load(spark, sf_dir)
    return changes.config_update(e.properties, e.config_updates, e.processors, e.auto_terminated)[1]


# --- H4, H5 ---------------------------------------------------------------------

_STATE_SQL = """
, comp AS (SELECT id, 'processor' AS kind, run_status FROM fx_processor
           UNION ALL SELECT id, 'port', run_status FROM fx_port),
x AS (SELECT s.target_id, c.kind, upper(s.state) AS requested_state, c.run_status AS previous_state,
        CASE WHEN s.state IS NULL OR upper(s.state) NOT IN ('RUNNING', 'STOPPED', 'DISABLED') THEN 'invalid_state'
             WHEN c.id IS NULL THEN 'not_found'
             WHEN c.kind = 'processor' AND upper(s.state) = 'DISABLED' THEN 'invalid_state' ELSE 'set' END AS status
      FROM fx_state_command s LEFT JOIN comp c ON c.id = s.target_id)
SELECT *, CASE WHEN status = 'set' THEN requested_state ELSE previous_state END AS new_state FROM x"""


@query("state_apply", ["fx_state_command", "fx_processor", "fx_port"], _STATE_SQL)
def q_state_apply(spark, sf_dir):
    """H4: run-state commands upper-cased and checked per kind (set / invalid_state / not_found)."""
    e = Estate.load(spark, sf_dir)
    return changes.state_apply(e.state_commands, e.processors, e.ports)


_MEMBERS_SQL = """
, m AS (SELECT id, group_id, run_status, validation_errors FROM fx_processor
        UNION ALL SELECT id, group_id, run_status, NULL FROM fx_port)
"""


@query("group_state_apply", ["fx_processor", "fx_port"], _MEMBERS_SQL + """
SELECT id, group_id, run_status AS previous_state, CASE group_id WHEN 'pg-n7' THEN 'RUNNING' ELSE 'STOPPED' END AS new_state
FROM m WHERE group_id IN ('pg-n7', 'pg-n3') AND coalesce(run_status, '') <> 'DISABLED'
  AND (validation_errors IS NULL OR validation_errors = '')""")
def q_group_state_apply(spark, sf_dir):
    """H5: start pg-n7, start and then stop pg-n3: every eligible component (not disabled, no validation errors)."""
    e = Estate.load(spark, sf_dir)
    requests = [("pg-n7", "running"), ("pg-n3", "running"), ("pg-n3", "Stopped")]
    return changes.group_state_apply(spark, requests, e.processors, e.ports)


_GROUP_STATE_SQL = _MEMBERS_SQL + """
SELECT m.id, group_id, run_status AS previous_state, CASE WHEN parent_id = 'pg-r1' THEN 'STOPPED' ELSE 'RUNNING' END AS new_state
FROM m JOIN fx_group g ON g.id = m.group_id WHERE coalesce(run_status, '') <> 'DISABLED'
  AND (validation_errors IS NULL OR validation_errors = '')"""


@query("group_state_apply_table", ["fx_group", "fx_processor", "fx_port"], _GROUP_STATE_SQL)
def q_group_state_apply_table(spark, sf_dir):
    """H5 with requests as a table: all groups started, those below pg-r1 then stopped, all asked for an unknown state."""
    e = Estate.load(spark, sf_dir)
    ask = lambda df, state, seq: df.select(
        F.col("id").alias("group_id"), F.lit(state).alias("state"), F.lit(seq).alias("seq"))
    requests = ask(e.groups, "running", 1).unionByName(ask(e.groups, "paused", 3)).unionByName(
        ask(e.groups.where("parent_id = 'pg-r1'"), "stopped", 2))
    return changes.group_state_apply(spark, requests, e.processors, e.ports)


# --- A3, A4 ---------------------------------------------------------------------

@query("provenance_stream", ["fx_provenance"], """
SELECT * FROM fx_provenance WHERE event_type = 'ERROR'""")
def q_provenance_stream(spark, sf_dir):
    """A3: ERROR provenance events followed as a stream (availableNow drain, event-id dedup)."""
    prov = view_over("fx_provenance", events=streams.read_event_stream(spark, sf_dir))
    return streams.drain(streams.provenance_stream(prov, "1 hour", event_type="ERROR"), "provenance")


@query("provenance_settled", ["fx_provenance"], """
SELECT * FROM fx_provenance""")
def q_provenance_settled(spark, sf_dir):
    """A3 with late events kept: the newer half first, then all events, so that half comes twice and half late."""
    prov = Estate.load(spark, sf_dir).provenance
    middle = prov.agg(F.percentile_approx(F.unix_micros(F.col("event_time").cast("timestamp")), 0.5).alias("m")).first().m
    src, sink, checkpoint = (shared_path(spark, f"settled-{d}") for d in ("src", "sink", "ckpt"))
    newer = F.unix_micros(F.col("event_time").cast("timestamp")) >= (middle or 0)
    for part in (prov.where(newer), prov):
        part.write.mode("append").parquet(src)
        stream = spark.readStream.schema(prov.schema).parquet(src)
        q = batch_sink.settle_events(stream, sink, checkpoint)
        q.awaitTermination()
    return batch_sink.settled_events(spark, sink, prov.schema)


@query("bulletin_stream", ["fx_bulletin"], """
SELECT * FROM fx_bulletin WHERE group_id = 'pg-n7'""")
def q_bulletin_stream(spark, sf_dir):
    """A4: bulletins of group pg-n7 followed as a stream (availableNow drain)."""
    ev = streams.read_event_stream(spark, sf_dir)
    cust = Estate.load(spark, sf_dir).fx.table("customer")
    bulletins = view_over("fx_bulletin", events=ev, customer=cust)
    return streams.drain(streams.bulletin_stream(bulletins, group_id="pg-n7"), "bulletins")


@query("versioned_apply_stream", ["fx_command", "fx_processor"], _VERSIONED_SQL + """
SELECT seq, target_id, op, expected_version, outcome, present_after, CAST(version_after AS DOUBLE) AS version_after
FROM res""", recursive=True)
def q_versioned_apply_stream(spark, sf_dir):
    """H2 as a stream: commands from the event files, entity state kept in a state store."""
    from ..streaming.versioned_stream import versioned_apply_stream

    ev = streams.read_event_stream(spark, sf_dir)
    cmds = view_over("fx_command", events=ev)
    initial = Estate.load(spark, sf_dir).processors.select("id", F.lit(0).cast("bigint").alias("version"))
    return nullable_as_double(streams.drain(versioned_apply_stream(cmds, initial), "versioned"), "version_after")


@query("pipeline_summary", ["fx_pipeline_spec", "fx_pipeline_name"], """
, fb AS (SELECT pipeline_id, MIN(CASE WHEN type IS NULL OR name IS NULL THEN i END) AS first_bad
         FROM fx_pipeline_spec GROUP BY pipeline_id),
x AS (SELECT s.pipeline_id, s.i, s.type, fb.first_bad FROM fx_pipeline_spec s JOIN fb ON fb.pipeline_id = s.pipeline_id),
agg AS (SELECT pipeline_id, first_bad,
          SUM(CASE WHEN first_bad IS NULL OR i < first_bad THEN 1 ELSE 0 END) AS created,
          MAX(CASE WHEN i = first_bad THEN CASE WHEN type IS NULL THEN 'type' ELSE 'name' END END) AS missing
        FROM x GROUP BY pipeline_id, first_bad)
SELECT n.pipeline_id, n.name, CAST(100.0 AS DOUBLE) AS x, CAST(100.0 AS DOUBLE) AS y,
  CAST(coalesce(created, 0) AS BIGINT) AS created, first_bad IS NULL AS success,
  CASE WHEN first_bad IS NULL
       THEN 'Successfully created pipeline ''' || n.name || ''' with ' || CAST(coalesce(created, 0) AS VARCHAR) || ' processors'
       ELSE 'Processor ' || CAST(first_bad AS VARCHAR) || ' missing required ''' || missing || ''' field' END AS message
FROM fx_pipeline_name n LEFT JOIN agg ON agg.pipeline_id = n.pipeline_id""")
def q_pipeline_summary(spark, sf_dir):
    """H1 per pipeline, those without steps too: group at (100, 100), steps created, message or the rejecting error."""
    e = Estate.load(spark, sf_dir)
    return changes.pipeline_summary(changes.pipeline_spec_expand(_specs(e)), e.pipeline_names)


@query("versioned_apply_strict", ["fx_command", "fx_processor"], _versioned_sql(("UPDATE",)) + """
SELECT seq, target_id, op, expected_version, outcome, present_after, CAST(version_after AS DOUBLE) AS version_after
FROM res""", recursive=True)
def q_versioned_apply_strict(spark, sf_dir):
    """H2 with UPDATE strict: an update of a missing entity is an error, a delete is not_found."""
    e = Estate.load(spark, sf_dir)
    initial = e.processors.select("id", F.lit(0).cast("bigint").alias("version"))
    return nullable_as_double(versioned.versioned_apply(e.commands, initial, strict_ops=["UPDATE"]),
                              "version_after")


@query("config_update_maps", ["fx_config_update", "fx_processor", "fx_property", "fx_auto_terminated"],
       _LAST_CONFIG_SQL + """
, cur AS (SELECT processor_id, string_agg(name || '=' || value, ';' ORDER BY name) AS props
          FROM fx_property GROUP BY processor_id),
cur_auto AS (SELECT processor_id, string_agg(value, ';' ORDER BY value) AS auto
             FROM fx_auto_terminated GROUP BY processor_id),
pu AS (SELECT processor_id, coalesce(string_agg(name || '=' || value, ';' ORDER BY name), '') AS props
       FROM lst WHERE update_type = 'properties' GROUP BY processor_id),
au AS (SELECT processor_id, coalesce(string_agg(value, ';' ORDER BY value), '') AS auto
       FROM lst WHERE update_type = 'auto-terminatedrelationships' GROUP BY processor_id)
SELECT p.id, coalesce(pu.props, cur.props) AS properties, coalesce(au.auto, cur_auto.auto) AS auto_terminated
FROM fx_processor p LEFT JOIN cur ON cur.processor_id = p.id LEFT JOIN pu ON pu.processor_id = p.id
LEFT JOIN au ON au.processor_id = p.id LEFT JOIN cur_auto ON cur_auto.processor_id = p.id""")
def q_config_update_maps(spark, sf_dir):
    """H3 on the nested config: each processor's property map and auto-terminated list after the updates."""
    e = Estate.load(spark, sf_dir)
    current = e.properties.groupBy(F.col("processor_id").alias("id")).agg(
        F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("properties"))
    auto = e.auto_terminated.groupBy(F.col("processor_id").alias("id")).agg(
        F.sort_array(F.collect_list("value")).alias("auto_terminated"))
    procs = e.processors.select("id").join(current, "id", "left").join(auto, "id", "left")
    out = _as_text(changes.config_update_maps(procs, e.config_updates), "properties")
    return out.select("id", "properties", F.array_join("auto_terminated", ";").alias("auto_terminated"))


# --- two snapshots in one job -----------------------------------------------------

SCOPE = ["snapshot_id"]
_RESTARTED = ("SELECT id, group_id, CASE WHEN run_status = 'STOPPED' THEN 'RUNNING' ELSE 'STOPPED' END AS run_status, "
              "validation_errors FROM fx_processor")
_FEWER_PROCESSORS = "SELECT * FROM fx_processor WHERE id NOT LIKE '%7'"


def _two(first, kept=None):
    """Rows of two snapshots, the second with those of the first that ``kept`` keeps (all, if not given); the table is computed once."""
    both, one = F.array(F.lit(1), F.lit(2)), F.array(F.lit(1))
    kept = F.expr(kept) if isinstance(kept, str) else kept
    return first.withColumn("snapshot_id", F.explode(both if kept is None else F.when(kept, both).otherwise(one)))


def _restarted(processors):
    return _two(processors).withColumn(
        "run_status", F.when(F.col("snapshot_id") == 1, F.col("run_status"))
        .when(F.col("run_status") == "STOPPED", "RUNNING").otherwise("STOPPED"))


def _fewer(table, column="id"):
    return _two(table, ~F.col(column).endswith("7"))


@query("delete_preflight_snapshots", ["fx_delete_command", "fx_processor", "fx_connection", "fx_group", "fx_port", "fx_queue"],
       two_snapshots(_DELETE_SQL, fx_processor=_RESTARTED, fx_connection="SELECT * FROM fx_connection WHERE group_id <> 'pg-n3'"))
def q_delete_preflight_snapshots(spark, sf_dir):
    """C3 over two snapshots: in the second other processors run and a group has no connections."""
    e = Estate.load(spark, sf_dir)
    facts = changes.delete_facts(_restarted(e.processors), _two(e.connections, "group_id <> 'pg-n3'"),
                                 _two(e.groups), _two(e.ports), _two(e.queue), SCOPE)
    return changes.delete_preflight(_two(e.delete_commands), facts, SCOPE)


@query("connection_validate_snapshots", ["fx_connection_request", "fx_processor", "fx_port"],
       two_snapshots(_CONNECTION_SQL, fx_processor=_FEWER_PROCESSORS))
def q_connection_validate_snapshots(spark, sf_dir):
    """C4 over two snapshots: some endpoints exist in the first only."""
    e = Estate.load(spark, sf_dir)
    comp = _fewer(e.processors.select("id", "group_id", F.lit("PROCESSOR").alias("kind"))).unionByName(
        _two(e.ports.select("id", "group_id", "kind")))
    requests = _two(e.connection_requests.withColumn("relationships", F.split("relationships", ";")))
    out = changes.connection_validate(requests, comp, SCOPE)
    return out.withColumn("relationships", F.array_join("relationships", ";"))


@query("pipeline_spec_expand_snapshots", ["fx_pipeline_spec"], two_snapshots(
    _SPEC_SQL, fx_pipeline_spec="SELECT * FROM fx_pipeline_spec WHERE (pipeline_id + i) % 11 <> 0"))
def q_pipeline_spec_expand_snapshots(spark, sf_dir):
    """H1 over two snapshots: specs of one pipeline id that break at different steps."""
    specs = _specs(Estate.load(spark, sf_dir))
    both = _two(specs, "(pipeline_id + i) % 11 <> 0")
    return _as_text(changes.pipeline_spec_expand(both, SCOPE), "config")


@query("versioned_table_snapshots", ["fx_command", "fx_processor"], two_snapshots(
    _TABLE_SQL, recursive=True, fx_command="SELECT * FROM fx_command WHERE seq % 3 <> 0",
    fx_processor=_FEWER_PROCESSORS))
def q_versioned_table_snapshots(spark, sf_dir):
    """H2 over two snapshots: other commands to fewer entities in the second; both tables after their batches."""
    e = Estate.load(spark, sf_dir)
    initial = _fewer(e.processors.select("id", F.lit(0).cast("bigint").alias("version"), F.lit("initial").alias("config")))
    commands = _two(e.commands, "seq % 3 <> 0")
    outcomes = versioned.versioned_apply(commands, initial, payload=["config"], scope=SCOPE)
    return versioned.versioned_table(outcomes, initial, payload=["config"], scope=SCOPE)


@query("config_update_snapshots", ["fx_config_update", "fx_processor", "fx_property", "fx_auto_terminated"], two_snapshots(
    _CONFIG_SQL, fx_config_update="SELECT * FROM fx_config_update WHERE seq <> 2", fx_processor=_FEWER_PROCESSORS,
    fx_property="SELECT * FROM fx_property WHERE processor_id NOT LIKE '%7'"))
def q_config_update_snapshots(spark, sf_dir):
    """H3 over two snapshots: the second lacks some commands, processors and properties."""
    e = Estate.load(spark, sf_dir)
    updates = _two(e.config_updates, "seq <> 2")
    return changes.config_update(_fewer(e.properties, "processor_id"), updates, _fewer(e.processors),
                                 _two(e.auto_terminated), SCOPE)[1]


@query("state_apply_snapshots", ["fx_state_command", "fx_processor", "fx_port"], two_snapshots(
    _STATE_SQL, fx_processor=_RESTARTED,
    fx_state_command="SELECT * FROM fx_state_command WHERE coalesce(state, '') <> 'running'"))
def q_state_apply_snapshots(spark, sf_dir):
    """H4 over two snapshots: other states before and fewer commands in the second."""
    e = Estate.load(spark, sf_dir)
    commands = _two(e.state_commands, "coalesce(state, '') <> 'running'")
    return changes.state_apply(commands, _restarted(e.processors), _two(e.ports), SCOPE)


@query("group_state_apply_snapshots", ["fx_group", "fx_processor", "fx_port"], two_snapshots(
    _GROUP_STATE_SQL, fx_processor=_RESTARTED, fx_group="SELECT * FROM fx_group WHERE parent_id <> 'pg-r2'"))
def q_group_state_apply_snapshots(spark, sf_dir):
    """H5 over two snapshots: other states before, and no request for the groups below pg-r2 in the second."""
    e = Estate.load(spark, sf_dir)
    ask = lambda df, state, seq: df.select(
        "snapshot_id", F.col("id").alias("group_id"), F.lit(state).alias("state"), F.lit(seq).alias("seq"))
    groups = _two(e.groups, "parent_id <> 'pg-r2'")
    requests = ask(groups, "running", 1).unionByName(ask(groups.where("parent_id = 'pg-r1'"), "stopped", 2))
    return changes.group_state_apply(spark, requests, _restarted(e.processors), _two(e.ports), SCOPE)
