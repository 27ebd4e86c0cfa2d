"""Physical plans: pushed filters, top-k, pruned scans, no Python in pure batch operators."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from flowlake.plans.catalog import QUERIES

# Operators that run Python by design (ordered fold / positions in a range-sorted layout).
PYTHON_BY_DESIGN = {k for k in QUERIES if k.startswith(("queue_listing", "versioned_apply", "versioned_table"))}
STREAMS = {"provenance_stream", "bulletin_stream", "versioned_apply_stream", "lint_documents_stream"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - PYTHON_BY_DESIGN - STREAMS))
def test_no_python_node(spark, key):
    plan = _plan(QUERIES[key](spark, SF001))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan, (key, node)


def test_provenance_search_topk_and_pushdown(spark):
    plan = _plan(QUERIES["provenance_search_component"](spark, SF001))
    assert "TakeOrderedAndProject" in plan
    assert "PushedFilters" in plan


def test_bulletin_feed_topk(spark):
    assert "TakeOrderedAndProject" in _plan(QUERIES["bulletin_feed_group"](spark, SF001))


def test_group_filter_pushed_to_scan(spark):
    from flowlake.sources.tables import Estate
    from flowlake.operators.browse import group_processors
    df = group_processors(Estate.load(spark, SF001).processors, ["pg-n7"])
    assert "ReadSchema" in _plan(df)


def test_route_has_no_shuffle(spark):
    assert "Exchange" not in _plan(QUERIES["relationship_route"](spark, SF001))


@pytest.mark.parametrize("key", sorted(set(QUERIES) - STREAMS - {"versioned_apply_stream"}))
def test_no_cartesian_product(spark, key):
    plan = _plan(QUERIES[key](spark, SF001))
    assert "CartesianProduct" not in plan, key
    # a nested-loop join may only come from Catalyst's existence check on a
    # constant row, whose build side is cut to one row per partition
    if "BroadcastNestedLoopJoin" in plan:
        assert "LocalLimit 1" in plan, key


def test_search_terms_reach_parquet_on_stored_table(spark, tmp_path):
    """On a stored provenance table the terms are pushed into the scan and only
    the summarized columns are read."""
    from flowlake.operators.provenance import provenance_search
    from flowlake.sources.tables import Estate
    path = str(tmp_path / "prov")
    Estate.load(spark, SF001).provenance.write.parquet(path)
    df = provenance_search(spark.read.parquet(path), {"componentId": "proc-c46", "flowFileUuid": "ff-7"}, 20)
    plan = _formatted(df)
    assert "EqualTo(component_id,proc-c46)" in plan and "EqualTo(flowfile_uuid,ff-7)" in plan
    assert "details" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert "TakeOrderedAndProject" in plan


def test_fact_layout_prunes_dates(spark, tmp_path):
    from flowlake.sources.facts import read_facts, write_facts
    from flowlake.sources.tables import Estate
    from flowlake.operators.provenance import provenance_search
    path = str(tmp_path / "facts")
    prov = Estate.load(spark, SF001).provenance
    write_facts(prov, path, "event_time")
    dates = sorted(r[0] for r in spark.read.parquet(path).select("event_date").distinct().collect())
    assert len(dates) > 1
    df = provenance_search(read_facts(spark, path, start=dates[-1]), {"componentId": "proc-c46"}, 20)
    plan = _formatted(df)
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert df.count() == prov.where(F.to_date("event_time") >= F.lit(dates[-1])) \
        .where("component_id = 'proc-c46'").limit(20).count()
    start, end = f"{dates[1]} 06:00:00", f"{dates[3]} 18:00:00"
    df = provenance_search(spark.read.parquet(path), {}, 10**6, start=start, end=end)
    filters = next(line for line in _formatted(df).splitlines() if "PartitionFilters" in line)
    assert "event_date" in filters and str(dates[1]) in filters and str(dates[3]) in filters
    assert 0 < df.count() == prov.where(f"event_time between '{start}' and '{end}'").count() < prov.count()


def test_lookup_pushes_ids_into_scan(spark, tmp_path):
    from flowlake.operators.browse import entity_lookup
    from flowlake.sources.tables import Estate
    path = str(tmp_path / "prov")
    Estate.load(spark, SF001).provenance.write.parquet(path)
    df = entity_lookup(spark, spark.read.parquet(path), [7, 42, -1], key="event_id", id_type="bigint")
    plan = _formatted(df)
    assert "In(event_id, [-1,42,7])" in plan or "In(event_id, [7,42,-1])" in plan, plan
    assert {r["requested_id"]: r["found"] for r in df.collect()} == {7: True, 42: True, -1: False}
