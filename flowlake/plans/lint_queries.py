"""Queries for the lint operators."""

from __future__ import annotations

from ..operators import lint
from ..sources.tables import Estate
from .registry import nullable_as_double, query

COUNTS = ("processor_count", "connection_count")

_DISCONNECTED_SQL = """
SELECT p.group_id, p.id AS processor_id, 'disconnected' AS rule,
  'Processor ''' || coalesce(p.name, 'Unknown') || ''' (ID: ' || p.id || ') is not connected to any other component.' AS suggestion
FROM fx_processor p
WHERE NOT EXISTS (SELECT 1 FROM fx_connection c
                  WHERE c.group_id = p.group_id AND (c.source_id = p.id OR c.destination_id = p.id))
"""

_STOPPED_SQL = """
SELECT group_id, id AS processor_id, 'stopped' AS rule,
  'Processor ''' || coalesce(name, 'Unknown') || ''' is stopped. Consider starting it if it should be running.' AS suggestion
FROM fx_processor WHERE coalesce(run_status, 'UNKNOWN') = 'STOPPED'
"""

_INVALID_SQL = """
SELECT group_id, id AS processor_id, 'invalid' AS rule,
  'Processor ''' || coalesce(name, 'Unknown') || ''' has validation errors: ' || replace(validation_errors, ';', ', ') AS suggestion
FROM fx_processor WHERE validation_errors IS NOT NULL AND validation_errors <> ''
"""


@query("lint_disconnected", ["fx_processor", "fx_connection"], _DISCONNECTED_SQL)
def q_lint_disconnected(spark, sf_dir):
    """Processors in no connection of their own group (anti join)."""
    e = Estate.load(spark, sf_dir)
    return lint.lint_disconnected(e.processors, e.connections)


@query("lint_stopped", ["fx_processor"], _STOPPED_SQL)
def q_lint_stopped(spark, sf_dir):
    """Processors whose run status is exactly STOPPED."""
    return lint.lint_stopped(Estate.load(spark, sf_dir).processors)


@query("lint_invalid", ["fx_processor"], _INVALID_SQL)
def q_lint_invalid(spark, sf_dir):
    """D3: processors with validation errors, joined by ', '."""
    return lint.lint_invalid(Estate.load(spark, sf_dir).processors)


_REPORT_SQL = f"""
, rules AS (
  {_DISCONNECTED_SQL} UNION ALL {_STOPPED_SQL} UNION ALL {_INVALID_SQL}
), pc AS (SELECT group_id, COUNT(*) AS n FROM fx_processor GROUP BY group_id),
cc AS (SELECT group_id, COUNT(*) AS n FROM fx_connection GROUP BY group_id)
SELECT r.group_id, r.rule,
  CASE r.rule WHEN 'disconnected' THEN 1 WHEN 'stopped' THEN 2 ELSE 3 END AS rule_order,
  r.processor_id, r.suggestion, CAST(pc.n AS DOUBLE) AS processor_count,
  CAST(coalesce(cc.n, 0) AS DOUBLE) AS connection_count
FROM rules r LEFT JOIN pc ON pc.group_id = r.group_id LEFT JOIN cc ON cc.group_id = r.group_id
UNION ALL
SELECT g.id, 'no_processors', 0, CAST(NULL AS VARCHAR),
  'No processors found. Add processors to start building your pipeline.', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
FROM fx_group g WHERE NOT EXISTS (SELECT 1 FROM fx_processor p WHERE p.group_id = g.id)
"""


@query("lint_report", ["fx_group", "fx_processor", "fx_connection"], _REPORT_SQL)
def q_lint_report(spark, sf_dir):
    """All lint suggestions for every group, in rule order, with group counts."""
    e = Estate.load(spark, sf_dir)
    return nullable_as_double(lint.lint_report(e.groups, e.processors, e.connections), *COUNTS)


def lint_report_sql() -> str:
    """The lint report oracle text (shared by the document-based query)."""
    return _REPORT_SQL
