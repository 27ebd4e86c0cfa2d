"""Two snapshots of a table cost one computation of it; the delete facts are aggregated by hash."""

from conftest import SF001
from flowlake.operators import changes
from flowlake.plans.change_queries import _fewer, _restarted, _two
from flowlake.sources.tables import Estate


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_two_snapshots_read_a_table_once(spark):
    e = Estate.load(spark, SF001)
    one = _plan(e.connections).count("Scan parquet")
    assert _plan(_two(e.connections, "group_id <> 'pg-n3'")).count("Scan parquet") == one
    rows = spark.createDataFrame([("a7", "STOPPED"), ("b", None), (None, "RUNNING")], "id string, run_status string")
    assert sorted(map(str, _fewer(rows).select("id", "snapshot_id").collect())) == sorted(
        f"Row(id={i!r}, snapshot_id={s})" for i, s in [("a7", 1), ("b", 1), ("b", 2), (None, 1)])
    assert sorted(map(str, _restarted(rows).select("run_status", "snapshot_id").collect())) == sorted(
        f"Row(run_status={r!r}, snapshot_id={s})" for r, s in
        [("STOPPED", 1), ("RUNNING", 2), (None, 1), ("STOPPED", 2), ("RUNNING", 1), ("STOPPED", 2)])


def test_delete_facts_aggregate_by_hash(spark):
    e = Estate.load(spark, SF001)
    facts = changes.delete_facts(e.processors, e.connections, e.groups, e.ports, e.queue)
    assert "SortAggregate" not in _plan(facts)
    assert {r[0] for r in facts.select("kind").distinct().collect()} == set(changes.KINDS)
