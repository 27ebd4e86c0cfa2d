"""Hand-made rows for every quirk in SURVEY §2.1."""

import pytest
from pyspark.sql import functions as F

from flowlake.operators import browse, changes, lint, provenance, route, tree
from flowlake.functions import text as T

PROC = "id string, group_id string, name string, type string, run_status string, version bigint, " \
       "validation_errors array<string>"
CONN = "id string, group_id string, source_id string, destination_id string"


def _procs(spark, rows):
    return spark.createDataFrame(rows, PROC)


def test_disconnected_self_loop_null_endpoint_other_group(spark):
    procs = _procs(spark, [
        ("a", "g", "A", "T", "RUNNING", 0, None),
        ("b", "g", "B", "T", "RUNNING", 0, None),
        ("c", "g", None, "T", "RUNNING", 0, None),
        ("d", "g", "D", "T", "RUNNING", 0, None),
    ])
    conns = spark.createDataFrame([
        ("c1", "g", "a", "a"),          # self-loop: a is connected
        ("c2", "g", None, "b"),         # null source counts for nothing, b connected
        ("c3", "g", "", None),          # empty / null endpoints: nothing
        ("c4", "h", "d", "x"),          # d connected only in another group
    ], CONN)
    got = {r["processor_id"]: r["suggestion"] for r in lint.lint_disconnected(procs, conns).collect()}
    assert set(got) == {"c", "d"}
    assert got["c"] == "Processor 'Unknown' (ID: c) is not connected to any other component."


def test_stopped_missing_status_and_case(spark):
    procs = _procs(spark, [
        ("a", "g", "A", "T", "STOPPED", 0, None),
        ("b", "g", "B", "T", None, 0, None),        # missing = UNKNOWN, not flagged
        ("c", "g", "C", "T", "stopped", 0, None),   # case-sensitive
        ("d", "g", "D", "T", "DISABLED", 0, None),
    ])
    assert [r["processor_id"] for r in lint.lint_stopped(procs).collect()] == ["a"]


def test_invalid_joins_errors(spark):
    procs = _procs(spark, [("a", "g", "A", "T", "RUNNING", 0, ["x", "y"]),
                           ("b", "g", "B", "T", "RUNNING", 0, []), ("c", "g", "C", "T", "RUNNING", 0, None)])
    rows = lint.lint_invalid(procs).collect()
    assert [r["suggestion"] for r in rows] == ["Processor 'A' has validation errors: x, y"]


def test_report_empty_group_and_order(spark):
    groups = spark.createDataFrame([("g", None), ("e", "g")], "id string, parent_id string")
    procs = _procs(spark, [("a", "g", "A", "T", "STOPPED", 0, ["bad"])])
    conns = spark.createDataFrame([], CONN)
    rows = lint.lint_report(groups, procs, conns).orderBy("group_id", "rule_order").collect()
    assert [(r["group_id"], r["rule"]) for r in rows] == [
        ("e", "no_processors"), ("g", "disconnected"), ("g", "stopped"), ("g", "invalid")]
    assert rows[0]["processor_count"] is None and rows[0]["connection_count"] is None
    assert rows[1]["processor_count"] == 1 and rows[1]["connection_count"] == 0
    assert rows[0]["suggestion"] == T.MSG_NO_PROCESSORS


def test_search_is_literal_and_case_insensitive(spark):
    df = spark.createDataFrame([("p1", "Foo_Bar", "X.Y"), ("p2", "fooXbar", "XaY"), ("p3", "100%", "T")],
                               "id string, name string, type string")
    hit = lambda q: sorted(r["id"] for r in browse.component_search(q, processor=df).collect())
    assert hit("o_b") == ["p1"]
    assert hit("X.Y") == ["p1"]
    assert hit("%") == ["p3"]
    assert hit("FOO") == ["p1", "p2"]


def test_provenance_unknown_key_capitalised(spark):
    ev = spark.createDataFrame([(1, "2024-01-01 00:00:00", "c", "f", "d", "ERROR")],
                               "event_id bigint, event_time string, component_id string, flowfile_uuid string, "
                               "details string, event_type string") \
        .withColumn("event_time", F.to_timestamp_ntz("event_time"))
    assert provenance.provenance_search(ev, {"DETAILS": "d"}, summarize=False).count() == 1
    with pytest.raises(ValueError):
        provenance.provenance_search(ev, {"eventType": "ERROR"})  # capitalised 'Eventtype' names no column
    with pytest.raises(ValueError):
        provenance.provenance_event_content(ev, ev, "Input")


def test_capitalize_is_not_initcap(spark):
    r = spark.range(1).select(T.capitalize(F.lit("hello WORLD")).alias("c")).first()
    assert r["c"] == "Hello world"


def test_sizes_and_durations(spark):
    df = spark.createDataFrame([("1 GB", "0 sec"), ("40 B", "365 days"), ("2 KB", "5 mins"), ("junk", "x")],
                               "s string, d string")
    rows = df.select(T.parse_data_size(F.col("s")).alias("b"), T.parse_duration_ms(F.col("d")).alias("ms")).collect()
    assert [(r["b"], r["ms"]) for r in rows] == [(1 << 30, 0), (40, 365 * 86_400_000), (2048, 300_000), (None, None)]


def test_state_apply_case_and_bad_state(spark):
    procs = _procs(spark, [("a", "g", "A", "T", "STOPPED", 0, None), ("b", "g", "B", "T", "RUNNING", 0, None)])
    ports = spark.createDataFrame([("pt", "g", "INPUT_PORT", "P", "RUNNING")],
                                  "id string, group_id string, kind string, name string, run_status string")
    cmds = spark.createDataFrame([("a", "running"), ("b", "PAUSED"), ("zz", "RUNNING"), ("pt", "disabled"),
                                  ("a", "DISABLED")], "target_id string, state string")
    got = sorted((r["target_id"], r["requested_state"], r["status"])
                 for r in changes.state_apply(cmds, procs, ports).collect())
    assert got == [("a", "DISABLED", "invalid_state"), ("a", "RUNNING", "set"), ("b", "PAUSED", "invalid_state"),
                   ("pt", "DISABLED", "set"), ("zz", "RUNNING", "not_found")]
    with pytest.raises(ValueError):
        changes.group_state_apply(spark, [("g", "paused")], procs)


def test_pipeline_spec_both_fields_missing(spark):
    specs = spark.createDataFrame([(1, 0, "T", "a", None), (1, 1, None, None, None), (1, 2, "T", "c", 5.0),
                                   (2, 0, "T", None, None)],
                                  "pipeline_id bigint, i bigint, type string, name string, x double")
    rows = {(r["pipeline_id"], r["i"]): r for r in changes.pipeline_spec_expand(specs).collect()}
    assert rows[(1, 0)]["status"] == "created" and rows[(1, 0)]["x"] == 200.0 and rows[(1, 0)]["y"] == 200.0
    assert rows[(1, 1)]["status"] == "rejected"
    assert rows[(1, 1)]["message"] == "Processor 1 missing required 'type' field"
    assert rows[(1, 2)]["status"] == "skipped" and rows[(1, 2)]["x"] == 5.0
    assert rows[(2, 0)]["message"] == "Processor 0 missing required 'name' field"


def test_config_update_replaces(spark):
    props = spark.createDataFrame([("a", "k1", "v1"), ("a", "k2", "v2"), ("b", "k1", "v1")],
                                  "processor_id string, name string, value string")
    upd = spark.createDataFrame([("a", "properties", "k3", "v3"), ("b", "auto-terminatedrelationships", None, "failure"),
                                 ("b", "comments", "x", "y"), ("zz", "properties", "k", "v")],
                                "processor_id string, update_type string, name string, value string")
    procs = _procs(spark, [("a", "g", "A", "T", "STOPPED", 0, None), ("b", "g", "B", "T", "STOPPED", 0, None)])
    status, config = changes.config_update(props, upd, procs)
    st = {(r[0], r[1]): r[2] for r in status.collect()}
    assert st == {("a", "properties"): "applied", ("b", "auto-terminatedrelationships"): "applied",
                  ("b", "comments"): "invalid_update_type", ("zz", "properties"): "not_found"}
    cfg = sorted(tuple(r) for r in config.collect())
    assert cfg == [("a", "properties", "k3", "v3"), ("b", "autoTerminatedRelationships", None, "failure"),
                   ("b", "properties", "k1", "v1")]


def test_route_multi_unmatched_and_termination(spark):
    df = spark.createDataFrame([(1, 5), (2, 50), (3, None), (4, -1)], "k int, v int")
    rules = {"small": F.col("v") < 10, "big": F.col("v") > 40, "neg": F.col("v") < 0}
    got = sorted((r["k"], r["relationship"]) for r in route.relationship_route(df, rules, ["neg"]).collect())
    assert got == [(1, "small"), (2, "big"), (3, "unmatched"), (4, "small")]


def test_pipeline_list_one_level_and_defaults(spark):
    groups = spark.createDataFrame([("r", None, None), ("a", "r", "A"), ("b", "r", None), ("c", "a", "C")],
                                   "id string, parent_id string, name string")
    got = sorted(tuple(r) for r in tree.pipeline_list(groups).collect())
    assert got == [("a", "A", "root"), ("b", "ProcessGroup-b", "root"), ("r", "root", "root")]
    deep = {r["id"]: (r["depth"], r["path"]) for r in tree.pipeline_tree(groups).collect()}
    assert deep["c"] == (2, "root/A/C")


def test_entity_lookup_reports_missing(spark):
    procs = _procs(spark, [("a", "g", "A", "T", "STOPPED", 0, None)])
    got = {r["requested_id"]: r["found"] for r in browse.entity_lookup(spark, procs, ["a", "nope"]).collect()}
    assert got == {"a": True, "nope": False}


def test_flow_docs_malformed_and_missing_lists(spark, tmp_path):
    from flowlake.operators import canvas
    from flowlake.sources.flowdocs import read_flow_docs
    p = tmp_path / "docs.json"
    p.write_text('{"id": "", "processGroupFlow": {"id": "root-1", "flow": {"processors": [{"id": "p1", '
                 '"component": {"name": "P", "validationErrors": ["v"]}}]}}}\n'
                 '{this is not json}\n'
                 '{"id": "g2", "processGroupFlow": {"id": "g2", "parentGroupId": "root-1"}}\n')
    docs = read_flow_docs(spark, str(p))
    bad = docs.select("id", "_corrupt_record").where(F.col("_corrupt_record").isNotNull()).collect()
    assert len(bad) == 1 and bad[0]["id"] is None
    good = docs.where(F.col("_corrupt_record").isNull())
    parts = canvas.canvas_explode(good)
    procs = parts["processors"].collect()
    assert [(r["id"], r["group_id"], r["validation_errors"]) for r in procs] == [("p1", "root-1", ["v"])]
    assert parts["connections"].count() == 0
    counts = {r["group_id"]: r["n_processors"] for r in canvas.flow_counts(good).collect()}
    assert counts == {"root-1": 1, "g2": 0}
    assert canvas.root_from_documents(good).first()["root_id"] == "root-1"


def test_fixtures_do_not_replace_caller_views(spark):
    from conftest import SF001
    from flowlake.plans.catalog import QUERIES
    spark.range(3).createOrReplaceTempView("region")
    QUERIES["root_group"](spark, SF001).collect()
    assert spark.table("region").count() == 3
    spark.catalog.dropTempView("region")


def test_delete_preflight_ports_groups_connections(spark):
    groups = spark.createDataFrame([("g", None, "G"), ("e", "g", "E"), ("h", "g", "H")],
                                   "id string, parent_id string, name string")
    procs = _procs(spark, [("a", "h", "A", "T", "STOPPED", 0, None), ("b", "h", "B", "T", "RUNNING", 0, None)])
    ports = spark.createDataFrame([("in1", "h", "INPUT_PORT", "I", "STOPPED"), ("out1", "h", "OUTPUT_PORT", "O", "STOPPED")],
                                  "id string, group_id string, kind string, name string, run_status string")
    conns = spark.createDataFrame([("c1", "h", "out1", "b"), ("c2", "h", "b", "b")], CONN)
    queue = spark.createDataFrame([("c1", "h", "f1", 3)], "connection_id string, group_id string, flowfile_uuid string, "
                                  "size_bytes bigint")
    cmds = spark.createDataFrame([("processor", "a"), ("processor", "b"), ("input_port", "in1"), ("output_port", "out1"),
                                  ("connection", "c1"), ("connection", "c2"), ("group", "e"), ("group", "h"),
                                  ("group", "zz")], "kind string, target_id string")
    facts = changes.delete_facts(procs, conns, groups, ports, queue)
    got = {(r["kind"], r["target_id"]): (r["allowed"], r["reasons"])
           for r in changes.delete_preflight(cmds, facts).collect()}
    assert got[("processor", "a")] == (True, "")
    assert got[("processor", "b")] == (False, "not_stopped, has_connections")
    assert got[("input_port", "in1")] == (True, "")
    assert got[("output_port", "out1")] == (False, "has_connections")
    assert got[("connection", "c1")] == (False, "queue_not_empty")
    assert got[("connection", "c2")] == (True, "")
    assert got[("group", "e")] == (True, "")
    assert got[("group", "h")] == (False, "not_stopped, not_empty")
    assert got[("group", "zz")] == (False, "not_found")


def test_connection_validate_rules(spark):
    comps = spark.createDataFrame([("p1", "g", "PROCESSOR"), ("p2", "g", "PROCESSOR"), ("i1", "g", "INPUT_PORT"),
                                   ("x", "other", "PROCESSOR")], "id string, group_id string, kind string")
    reqs = spark.createDataFrame([
        (1, "g", "p1", "processor", "p2", None, None),
        (2, "g", "p1", "WIDGET", "p2", "PROCESSOR", ""),
        (3, "g", "i1", "PROCESSOR", "p2", "PROCESSOR", "n"),
        (4, "g", "p1", "PROCESSOR", "x", "PROCESSOR", "n"),
        (5, "g", "zz", "PROCESSOR", "p2", "PROCESSOR", "n"),
    ], "request_id bigint, group_id string, source_id string, source_type string, destination_id string, "
       "destination_type string, name string")
    got = {r["request_id"]: r for r in changes.connection_validate(reqs, comps).collect()}
    assert got[1]["valid"] and got[1]["name"] == "Connection from p1 to p2" and got[1]["source_type"] == "PROCESSOR"
    assert (got[1]["bp_objects"], got[1]["bp_size"], got[1]["expiration"]) == (10000, "1 GB", "0 sec")
    assert got[2]["reasons"] == "bad_source_type, source_type_mismatch" and got[2]["name"] == "Connection from p1 to p2"
    assert got[3]["reasons"] == "source_type_mismatch"
    assert got[4]["reasons"] == "destination_other_group"
    assert got[5]["reasons"] == "source_not_found"


def test_config_update_maps_replaces_whole_values(spark):
    procs = spark.createDataFrame([("a", {"k1": "v1", "k2": "v2"}, ["success"]), ("b", {"k1": "v1"}, None)],
                                  "id string, properties map<string,string>, auto_terminated array<string>")
    upd = spark.createDataFrame([("a", "properties", "k3", "v3"), ("b", "auto-terminatedrelationships", None, "failure"),
                                 ("b", "comments", "x", "y")],
                                "processor_id string, update_type string, name string, value string")
    got = {r["id"]: (r["properties"], r["auto_terminated"]) for r in changes.config_update_maps(procs, upd).collect()}
    assert got == {"a": ({"k3": "v3"}, ["success"]), "b": ({"k1": "v1"}, ["failure"])}


def test_lint_documents_with_missing_and_repeated_ids(spark):
    """Processors without an id or with a repeated one: each is reported, as by the report on flat tables."""
    from flowlake.operators import canvas, lint
    from flowlake.sources.flowdocs import build_flow_docs
    groups = spark.createDataFrame([("g", None, "G"), ("h", "g", "H")], "id string, parent_id string, name string")
    procs = spark.createDataFrame(
        [(None, "g", "lost", "T", "STOPPED", 0, None), (None, "g", "lost too", "T", "RUNNING", 0, ["e1", "e2"]),
         ("a", "g", "one", "T", "RUNNING", 0, None), ("a", "g", "two", "T", "STOPPED", 0, None),
         ("b", "g", "three", "T", "RUNNING", 0, None), ("a", "h", None, "T", "RUNNING", 0, None)],
        "id string, group_id string, name string, type string, run_status string, version long, "
        "validation_errors array<string>")
    conns = spark.createDataFrame([("c", "g", "b", None, 1, "1 GB", "0 sec"), ("d", "h", "", "b", 1, "1 GB", "0 sec")],
                                  "id string, group_id string, source_id string, destination_id string, "
                                  "bp_objects long, bp_size string, expiration string")
    ports = spark.createDataFrame([], "id string, group_id string, kind string, name string, run_status string")
    docs = build_flow_docs(groups, procs, conns, ports)
    cols = ["group_id", "rule", "processor_id", "suggestion", "processor_count", "connection_count"]
    got = sorted(map(str, lint.lint_documents(docs).select(*cols).collect()))
    flat = canvas.canvas_explode(docs)
    report = lint.lint_report(canvas.document_groups(docs), flat["processors"], flat["connections"])
    assert got == sorted(map(str, report.select(*cols).collect()))
    assert sum("rule='disconnected'" in x for x in got) == 5


def test_cluster_needs_a_shared_folder(monkeypatch):
    from flowlake import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_provenance_inverse_keeps_rows_without_a_value(spark):
    from flowlake.operators.provenance import provenance_search
    ev = spark.createDataFrame([(1, None), (2, "p"), (3, "q")], "event_id long, component_id string") \
        .withColumn("event_time", F.current_timestamp())
    got = provenance_search(ev, {"componentId": ("p", True)}).collect()
    assert {r["event_id"] for r in got} == {1, 3}


def test_state_apply_of_unknown_and_missing(spark):
    from flowlake.operators.changes import state_apply
    procs = spark.createDataFrame([("p", "RUNNING")], "id string, run_status string")
    ports = spark.createDataFrame([("i", "RUNNING")], "id string, run_status string")
    cmds = [("p", "DISABLED"), ("p", None), ("p", "stopped"), ("i", "Disabled"), ("x", "disabled"), ("x", "OFF"), ("x", None)]
    got = state_apply(spark.createDataFrame(cmds, "target_id string, state string"), procs, ports).collect()
    assert sorted((r["target_id"], r["requested_state"] or "", r["status"], r["new_state"] or "") for r in got) == sorted([
        ("p", "DISABLED", "invalid_state", "RUNNING"), ("p", "", "invalid_state", "RUNNING"), ("p", "STOPPED", "set", "STOPPED"),
        ("i", "DISABLED", "set", "DISABLED"), ("x", "DISABLED", "not_found", ""), ("x", "OFF", "invalid_state", ""),
        ("x", "", "invalid_state", "")])


def test_config_updates_repeat_and_empty(spark):
    from flowlake.operators.changes import config_update, config_update_maps
    props = spark.createDataFrame([("p", "a", "1"), ("q", "b", "2"), ("r", "c", "3")], "processor_id string, name string, value string")
    auto = spark.createDataFrame([("p", "ok"), ("q", "ok")], "processor_id string, value string")
    procs = spark.createDataFrame([("p",), ("q",), ("r",)], "id string")
    ups = spark.createDataFrame([
        (1, "p", "properties", "x", "old"), (2, "p", "properties", "y", "new"), (2, "p", "properties", "z", "new"),
        (5, "q", "properties", None, None), (3, "q", "properties", "lost", "v"),
        (4, "q", "auto-terminatedrelationships", None, "retry"), (9, "r", None, "x", "x"), (9, "n", "properties", "x", "x")],
        "seq int, processor_id string, update_type string, name string, value string")
    status, config = config_update(props, ups, procs, auto)
    assert {tuple(r) for r in config.collect()} == {
        ("p", "properties", "y", "new"), ("p", "properties", "z", "new"), ("r", "properties", "c", "3"),
        ("p", "autoTerminatedRelationships", None, "ok"), ("q", "autoTerminatedRelationships", None, "retry")}
    assert {(r[0], r[2]) for r in status.collect()} == {
        ("p", "applied"), ("q", "applied"), ("r", "invalid_update_type"), ("n", "not_found")}
    nested = spark.createDataFrame([("p", {"a": "1"}, ["ok"]), ("q", {"b": "2"}, ["ok"]), ("r", {"c": "3"}, None)],
                                   "id string, properties map<string,string>, auto_terminated array<string>")
    got = {r["id"]: (r["properties"], r["auto_terminated"]) for r in config_update_maps(nested, ups).collect()}
    assert got == {"p": ({"y": "new", "z": "new"}, ["ok"]), "q": ({}, ["retry"]), "r": ({"c": "3"}, None)}


def test_root_group_must_exist(spark):
    groups = spark.createDataFrame([("a", None, None), ("b", "a", "B")], "id string, parent_id string, name string")
    assert [tuple(r) for r in browse.root_group(groups, "top").collect()] == [("a", "top", None)]
    for none in (groups.where("id = 'b'"), groups.limit(0)):
        with pytest.raises(Exception, match="root process group id not found"):
            browse.root_group(none).collect()
