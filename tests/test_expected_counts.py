"""Counts pinned in FIXTURES.md Part 4 (sf0.01)."""

from collections import Counter

from pyspark.sql import functions as F

from conftest import SF01
from flowlake.plans.catalog import QUERIES


def _counts(df, col):
    return Counter({r[0]: r[1] for r in df.groupBy(col).count().collect()})


def test_lint_counts(spark):
    rep = QUERIES["lint_report"](spark, SF01)
    c = _counts(rep, "rule")
    assert c == Counter({"disconnected": 462, "stopped": 407, "invalid": 128, "no_processors": 1511})
    assert rep.count() == 2508


def test_effective_parameters(spark):
    assert QUERIES["effective_parameters"](spark, SF01).count() == 9211


def test_group_status_subtrees(spark):
    rows = {r["group_id"]: r for r in QUERIES["group_status"](spark, SF01).collect()}
    assert rows["pg-root"]["total_processors"] == 1625 and rows["pg-r2"]["total_processors"] == 337
    assert rows["pg-root"]["total_queued_items"] == 30064 and rows["pg-r2"]["total_queued_items"] == 6007
    assert rows["pg-root"]["total_queued_bytes"] == 761737 and rows["pg-r2"]["total_queued_bytes"] == 152878


def test_delete_preflight_allowed(spark):
    df = QUERIES["delete_preflight"](spark, SF01).where("allowed")
    assert _counts(df, "kind") == Counter({"processor": 7, "connection": 21532, "group": 1505})


def test_connection_validate(spark):
    assert QUERIES["connection_validate"](spark, SF01).where("valid").count() == 231


def test_provenance_matches_before_limit(spark, estate01):
    from flowlake.operators.provenance import provenance_search
    ev = estate01.provenance
    assert provenance_search(ev, {"componentId": "proc-c46"}, max_results=100000).count() == 72
    assert provenance_search(ev, {"flowFileUuid": "ff-7"}, max_results=100000).count() == 20


def test_event_content_found(spark):
    df = QUERIES["provenance_event_content"](spark, SF01).where("direction = 'input'")
    assert df.count() == 10000 and df.where("found").count() == 8000


def test_pipeline_spec_counts(spark):
    c = _counts(QUERIES["pipeline_spec_expand"](spark, SF01), "status")
    assert c == Counter({"created": 265, "rejected": 64, "skipped": 207})


def test_versioned_counts(spark):
    c = _counts(QUERIES["versioned_apply"](spark, SF01), "outcome")
    assert c == Counter({"conflict": 5899, "created": 248, "deleted": 255, "exists": 1730, "invalid_op": 111,
                         "no_target": 104, "not_found": 930, "updated": 723})


def test_state_apply_counts(spark):
    c = _counts(QUERIES["state_apply"](spark, SF01), "status")
    assert c == Counter({"set": 1134, "invalid_state": 667, "not_found": 2})


def test_group_state_apply(spark):
    assert QUERIES["group_state_apply"](spark, SF01).count() == 100


def test_route_before_termination(spark, estate01):
    from flowlake.operators.route import relationship_route
    li = estate01.fx.table("lineitem")
    rules = {"success": F.col("l_returnflag") == "A", "large": F.col("l_quantity") > 40,
             "failure": F.col("l_returnflag") == "R"}
    assert relationship_route(li, rules).count() == 67896


def test_expiry(spark):
    df = QUERIES["flowfile_expiry"](spark, SF01)
    assert df.count() == 14962 and df.where("expired").count() == 7632


def test_stream_drain(spark):
    assert QUERIES["provenance_stream"](spark, SF01).count() == 2014


def test_flow_doc_round_trip(spark):
    counts = QUERIES["flow_counts"](spark, SF01)
    assert counts.count() == 1536
    assert counts.where("n_processors = 0").count() == 1511
