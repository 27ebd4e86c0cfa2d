"""Flat flow-estate tables derived from the driver's TPC-H-ish parquet tables.

Each view is one SQL text that runs unchanged in Spark SQL and in DuckDB, so the
same stand-in input feeds the Spark operators and the independent oracle.  The
views only shape rows into the schemas the operators expect; none of them does
an operator's work.
"""

from __future__ import annotations

import itertools
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import discard, written

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed view texts (dependency order).  Both engines run them verbatim.
VIEWS: dict[str, str] = {
    "fx_group": """
SELECT 'pg-root' AS id, CAST(NULL AS STRING) AS parent_id, 'Root' AS name
UNION ALL SELECT 'pg-r' || CAST(r_regionkey AS STRING), 'pg-root', r_name FROM region
UNION ALL SELECT 'pg-e' || CAST(r_regionkey AS STRING), 'pg-r' || CAST(r_regionkey AS STRING), 'EMPTY_' || r_name FROM region
UNION ALL SELECT 'pg-n' || CAST(n_nationkey AS STRING), 'pg-r' || CAST(n_regionkey AS STRING), n_name FROM nation
UNION ALL SELECT 'pg-c' || CAST(c_custkey AS STRING), 'pg-n' || CAST(c_nationkey AS STRING), c_name FROM customer
""",
    "fx_processor": """
SELECT p || CAST(k AS STRING) AS id, 'pg-n' || CAST(nk AS STRING) AS group_id, nm AS name, ty AS type,
  CASE k % 4 WHEN 0 THEN 'STOPPED' WHEN 1 THEN 'DISABLED' ELSE 'RUNNING' END AS run_status,
  CAST(k % 3 AS BIGINT) AS version,
  CASE WHEN bal < -500 THEN 'balance below limit;balance below zero' WHEN bal < 0 THEN 'balance below zero' END AS validation_errors
FROM (SELECT 'proc-s' AS p, s_suppkey AS k, s_nationkey AS nk, s_name AS nm, 'SupplierFeed' AS ty, s_acctbal AS bal FROM supplier
  UNION ALL SELECT 'proc-c', c_custkey, c_nationkey, c_name, 'CustomerSink', c_acctbal FROM customer
  UNION ALL SELECT 'proc-i', n_nationkey, n_nationkey, 'idle ' || n_name, 'IdleTask', CAST(n_nationkey AS DOUBLE) FROM nation) x
""",
    "fx_transfer": """
SELECT 'conn-' || CAST(l_suppkey AS STRING) || '-' || CAST(o_custkey AS STRING) AS connection_id,
  'pg-n' || CAST(s_nationkey AS STRING) AS group_id, l_suppkey AS s_key,
  'proc-s' || CAST(l_suppkey AS STRING) AS source_id, 'proc-c' || CAST(o_custkey AS STRING) AS destination_id,
  CASE l_returnflag WHEN 'A' THEN 'success' WHEN 'R' THEN 'failure' ELSE 'retry' END AS relationship,
  l_linestatus AS item_status,
  'ff-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS flowfile_uuid,
  CAST(l_quantity AS BIGINT) AS size_bytes, l_shipdate AS queued_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN customer ON o_custkey = c_custkey
""",
    "fx_queue": """
SELECT connection_id, group_id, flowfile_uuid, size_bytes, queued_at FROM fx_transfer WHERE item_status = 'O'
""",
    "fx_connection": """
SELECT DISTINCT connection_id AS id, group_id, source_id, destination_id,
  CAST(CASE WHEN s_key % 2 = 0 THEN 10000 ELSE 2 END AS BIGINT) AS bp_objects,
  CASE WHEN s_key % 3 = 0 THEN '40 B' ELSE '1 GB' END AS bp_size,
  CASE WHEN s_key % 2 = 0 THEN '0 sec' ELSE '365 days' END AS expiration
FROM fx_transfer
""",
    "fx_connection_rel": """
SELECT DISTINCT connection_id, relationship FROM fx_transfer
""",
    "fx_port": """
SELECT 'in-n' || CAST(n_nationkey AS STRING) AS id, 'pg-n' || CAST(n_nationkey AS STRING) AS group_id, 'INPUT_PORT' AS kind, 'in ' || n_name AS name,
  CASE n_nationkey % 2 WHEN 0 THEN 'RUNNING' ELSE 'STOPPED' END AS run_status FROM nation
UNION ALL SELECT 'out-n' || CAST(n_nationkey AS STRING), 'pg-n' || CAST(n_nationkey AS STRING), 'OUTPUT_PORT', 'out ' || n_name,
  CASE n_nationkey % 3 WHEN 0 THEN 'DISABLED' ELSE 'RUNNING' END FROM nation
""",
    "fx_funnel": """
SELECT 'fn-' || CAST(s_suppkey AS STRING) AS id, 'pg-n' || CAST(s_nationkey AS STRING) AS group_id FROM supplier WHERE s_acctbal > 5000
""",
    "fx_label": """
SELECT 'lb-' || CAST(c_custkey AS STRING) AS id, 'pg-n' || CAST(c_nationkey AS STRING) AS group_id FROM customer WHERE c_acctbal > 9000
""",
    "fx_provenance": """
SELECT event_id, ts AS event_time, upper(event_type) AS event_type,
  CASE WHEN event_id % 41 <> 0 THEN 'proc-c' || CAST(user_id AS STRING) END AS component_id,
  'ff-' || CAST(event_id % 500 AS STRING) AS flowfile_uuid, event_id % 1250 AS input_claim, (event_id + 1) % 1250 AS output_claim, props AS details
FROM events
""",
    "fx_content": """
SELECT doc_id AS claim_id, text AS body FROM documents
""",
    "fx_bulletin": """
SELECT event_id AS id, ts, 'pg-n' || CAST(c_nationkey AS STRING) AS group_id, 'proc-c' || CAST(user_id AS STRING) AS source_id,
  CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'WARNING' END AS level, props AS message
FROM events JOIN customer ON user_id = c_custkey WHERE event_type IN ('error', 'view')
""",
    "fx_parameter": """
SELECT 'pg-root' AS group_id, 'ENV' AS name, 'test' AS value
UNION ALL SELECT 'pg-r' || CAST(n_regionkey AS STRING), c_mktsegment, CAST(COUNT(*) AS STRING)
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey, c_mktsegment
UNION ALL SELECT 'pg-n' || CAST(c_nationkey AS STRING), c_mktsegment, CAST(COUNT(*) AS STRING)
  FROM customer WHERE c_nationkey % 2 = 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY c_nationkey, c_mktsegment
""",
    "fx_processor_type": """
SELECT p_type AS type, p_brand AS bundle, CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE p_type || ' by ' || p_brand END AS description, MIN(p_name) AS tags
FROM part GROUP BY p_type, p_brand
""",
    "fx_pipeline_spec": """
SELECT conv_id AS pipeline_id, turn AS i, CASE WHEN role = 'system' THEN NULL ELSE role END AS type,
  CASE WHEN (conv_id + turn) % 11 = 0 THEN NULL ELSE 'step-' || CAST(turn AS STRING) END AS name,
  CASE WHEN turn % 3 = 0 THEN CAST(turn * 10 AS DOUBLE) END AS x,
  CASE WHEN turn % 2 = 0 THEN 'batch=' || CAST(turn AS STRING) END AS config
FROM conversations
""",
    "fx_pipeline_name": """
SELECT DISTINCT conv_id AS pipeline_id, 'pipe ' || CAST(conv_id AS STRING) AS name FROM conversations
UNION ALL SELECT -1 - conv_id, 'without steps ' || CAST(conv_id AS STRING) FROM conversations WHERE turn = 0
""",
    "fx_command": """
SELECT event_id + 9007199254740993 AS seq,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 20 = 0 THEN 'proc-hot' ELSE 'proc-c' || CAST(user_id AS STRING) END AS target_id,
  CASE WHEN event_id % 89 = 0 THEN '__init__' WHEN event_type = 'purchase' THEN 'DELETE' WHEN event_type = 'signup' THEN 'CREATE' ELSE 'UPDATE' END AS op,
  CAST(event_id % 4 AS BIGINT) AS expected_version, props AS config FROM events
""",
    "fx_delete_command": """
SELECT 'processor' AS kind, id AS target_id FROM fx_processor
UNION ALL SELECT 'connection', id FROM fx_connection
UNION ALL SELECT 'group', id FROM fx_group
UNION ALL SELECT 'processor', 'proc-none'
""",
    "fx_late_queue": """
SELECT connection_id, group_id, flowfile_uuid, size_bytes, queued_at FROM fx_transfer WHERE queued_at >= TIMESTAMP '2001-10-20 00:00:00'
""",
    "fx_delete_batch": """
SELECT DISTINCT CAST(s_key AS BIGINT) AS seq, 'connection' AS kind, connection_id AS target_id, CAST(CASE WHEN s_key % 50 = 49 THEN 1 ELSE 0 END AS BIGINT) AS expected_version
FROM fx_transfer
UNION ALL SELECT CAST(50 + c_custkey % 200 AS BIGINT), 'processor', 'proc-c' || CAST(c_custkey AS STRING), CAST(CASE WHEN c_custkey % 13 = 0 THEN 7 ELSE c_custkey % 3 END AS BIGINT) FROM customer
UNION ALL SELECT CAST(1000000 + c_custkey AS BIGINT), 'processor', 'proc-c' || CAST(c_custkey AS STRING), CAST(c_custkey % 3 AS BIGINT) FROM customer
UNION ALL SELECT CAST(2000000 + n_nationkey AS BIGINT), 'processor', 'proc-i' || CAST(n_nationkey AS STRING), CAST(n_nationkey % 3 AS BIGINT) FROM nation
UNION ALL SELECT CAST(2000000 + n_nationkey AS BIGINT), CASE WHEN n_nationkey % 5 = 0 THEN 'widget' ELSE 'input_port' END, 'in-n' || CAST(n_nationkey AS STRING), CAST(0 AS BIGINT) FROM nation
UNION ALL SELECT CAST(2000000 + n_nationkey AS BIGINT), 'output_port', CASE WHEN n_nationkey % 7 <> 0 THEN 'out-n' || CAST(n_nationkey AS STRING) END, CAST(0 AS BIGINT) FROM nation
UNION ALL SELECT CAST(3000000 AS BIGINT), 'group', id, CAST(0 AS BIGINT) FROM fx_group
UNION ALL SELECT CAST(3000001 AS BIGINT), 'group', id, CAST(0 AS BIGINT) FROM fx_group
UNION ALL SELECT CAST(3000002 AS BIGINT), 'group', id, CAST(0 AS BIGINT) FROM fx_group
""",
    "fx_state_command": """
SELECT id AS target_id, CASE CAST(version AS INT) WHEN 0 THEN 'running' WHEN 1 THEN 'Stopped' ELSE 'PAUSED' END AS state FROM fx_processor
UNION ALL SELECT id, 'disabled' FROM fx_port
UNION ALL SELECT id, CAST(NULL AS STRING) FROM fx_port WHERE kind = 'INPUT_PORT'
UNION ALL SELECT id, CAST(NULL AS STRING) FROM fx_processor WHERE type = 'SupplierFeed'
UNION ALL SELECT 'proc-none', 'RUNNING'
UNION ALL SELECT 'proc-gone', 'DISABLED'
UNION ALL SELECT 'proc-lost', 'PAUSED'
""",
    "fx_property": """
SELECT id AS processor_id, 'label' AS name, name AS value FROM fx_processor
UNION ALL SELECT id, 'kind', type FROM fx_processor
""",
    "fx_auto_terminated": """
SELECT id AS processor_id, 'success' AS value FROM fx_processor WHERE version <> 2
""",
    "fx_config_update": """
SELECT 1 AS seq, id AS processor_id, CASE WHEN version = 0 THEN 'properties' WHEN version = 1 THEN 'auto-terminatedrelationships' ELSE 'comments' END AS update_type,
  'label' AS name, 'new' AS value FROM fx_processor WHERE run_status = 'STOPPED'
UNION ALL SELECT 2, id, 'properties', 'label', 'newer' FROM fx_processor WHERE run_status = 'STOPPED' AND version = 0 AND type = 'SupplierFeed'
UNION ALL SELECT 2, id, 'properties', 'extra', 'more' FROM fx_processor WHERE run_status = 'STOPPED' AND version = 0 AND type = 'SupplierFeed'
UNION ALL SELECT 3, id, 'properties', CAST(NULL AS STRING), CAST(NULL AS STRING) FROM fx_processor WHERE run_status = 'STOPPED' AND version = 1
UNION ALL SELECT 2, id, 'auto-terminatedrelationships', CAST(NULL AS STRING), 'failure' FROM fx_processor WHERE run_status = 'STOPPED' AND version = 1 AND type = 'SupplierFeed'
UNION ALL SELECT 1, 'proc-none', 'properties', 'label', 'new'
""",
    "fx_connection_request": """
SELECT event_id AS request_id, 'pg-n' || CAST(c_nationkey AS STRING) AS group_id, 'proc-s' || CAST(event_id % 120 AS STRING) AS source_id,
  CASE event_id % 5 WHEN 0 THEN 'processor' WHEN 1 THEN 'WIDGET' ELSE 'PROCESSOR' END AS source_type,
  'proc-c' || CAST(user_id AS STRING) AS destination_id, 'PROCESSOR' AS destination_type,
  CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'link' END AS name,
  CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'success' ELSE 'success;failure' END AS relationships
FROM events JOIN customer ON user_id = c_custkey
""",
}

_DEPENDS = {
    "fx_queue": ["fx_transfer"],
    "fx_connection": ["fx_transfer"],
    "fx_connection_rel": ["fx_transfer"],
    "fx_delete_command": ["fx_processor", "fx_connection", "fx_group"],
    "fx_late_queue": ["fx_transfer"],
    "fx_delete_batch": ["fx_transfer", "fx_group"],
    "fx_state_command": ["fx_processor", "fx_port"],
    "fx_property": ["fx_processor"],
    "fx_auto_terminated": ["fx_processor"],
    "fx_config_update": ["fx_processor"],
}


def closure(names) -> list[str]:
    """The named views plus the views they read, in dependency order."""
    need: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n not in need:
            need.add(n)
            stack.extend(_DEPENDS.get(n, []))
    return [v for v in VIEWS if v in need]


def with_clause(names) -> str:
    """A ``WITH`` list defining the named views for a DuckDB oracle query."""
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in closure(names)]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


def base_tables_of(name: str) -> list[str]:
    """Base tables a view's text reads (word match on the table names)."""
    text = VIEWS[name]
    return [t for t in BASE_TABLES if re.search(rf"\b{t}\b", text)]


_NAMES = BASE_TABLES + list(VIEWS)
_NAME_RE = re.compile(r"\b(" + "|".join(_NAMES) + r")\b")
_counter = itertools.count()


def view_over(view: str, **tables: DataFrame) -> DataFrame:
    """A view's text over the given tables, for example streams, in place of the files."""
    prefix = f"_fl{next(_counter)}_{uuid.uuid4().hex[:6]}_"
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
    spark = next(iter(tables.values())).sparkSession
    return spark.sql(_NAME_RE.sub(lambda m: prefix + m.group(1), VIEWS[view]))


class Fixtures:
    """Lazily built fixture DataFrames for one scale-factor directory.

    Tables and views are registered under names private to this instance (the
    view texts are rewritten to use them), so the caller's own temp views are
    never replaced.  Every fixture DataFrame is analysed when it is built and
    does not change afterwards.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.prefix = f"_fl{next(_counter)}_{uuid.uuid4().hex[:6]}_"
        self._frames: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def _sql(self, name: str) -> str:
        return _NAME_RE.sub(lambda m: self.prefix + m.group(1), VIEWS[name])

    def keep(self, name: str) -> None:
        """Write a view's rows once; the views over it that are built after this read files, not the view."""
        self._frames[name] = written(self[name], name)

    def discard(self, name: str) -> None:
        """Delete the files of a kept view that nothing reads any more."""
        discard(self._frames.pop(name))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            for dep in closure([name]):
                if dep not in self._frames:
                    for t in base_tables_of(dep):
                        self.table(t).createOrReplaceTempView(self.prefix + t)
                    for d in _DEPENDS.get(dep, []):
                        self._frames[d].createOrReplaceTempView(self.prefix + d)
                    self._frames[dep] = self.spark.sql(self._sql(dep))
        return self._frames[name]
