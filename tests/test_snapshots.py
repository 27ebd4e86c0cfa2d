"""Several snapshots loaded together: a scoped run equals separate runs per snapshot."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from flowlake.operators import changes, graph, lint, status, tree, versioned
from flowlake.sources.tables import Estate

SCOPE = ["snapshot_id"]


@pytest.fixture(scope="module")
def snaps(spark):
    e = Estate.load(spark, SF001)
    s1 = {"groups": e.groups, "processors": e.processors, "connections": e.connections, "queue": e.queue,
          "parameters": e.parameters, "rels": e.connection_relationships, "ports": e.ports,
          "deletes": e.delete_commands, "requests": e.connection_requests, "specs": e.pipeline_specs,
          "names": e.pipeline_names, "commands": e.commands, "updates": e.config_updates, "properties": e.properties,
          "auto": e.auto_terminated, "states": e.state_commands,
          "group_requests": e.groups.select(F.col("id").alias("group_id"), F.lit("running").alias("state"),
                                            F.lit(1).alias("seq"))}
    # snapshot 2: same ids, other states, fewer connections and a moved group
    s2 = dict(s1)
    s2["processors"] = e.processors.withColumn(
        "run_status", F.when(F.col("run_status") == "STOPPED", "RUNNING").otherwise("STOPPED"))
    s2["connections"] = e.connections.where(F.col("group_id") != "pg-n3")
    s2["queue"] = e.queue.where(F.col("size_bytes") > 20)
    s2["groups"] = e.groups.withColumn("parent_id", F.when(F.col("id") == "pg-n1", "pg-r4")
                                       .otherwise(F.col("parent_id")))
    s2["parameters"] = e.parameters.where(F.col("group_id") != "pg-root")
    s2["deletes"] = e.delete_commands.where("target_id NOT LIKE '%3'")
    s2["specs"] = e.pipeline_specs.where("(pipeline_id + i) % 11 <> 0")
    s2["commands"] = e.commands.where("seq % 3 <> 0")
    s2["updates"] = e.config_updates.where("seq <> 2")
    s2["properties"] = e.properties.where("processor_id NOT LIKE '%7'")
    s2["states"] = e.state_commands.where("coalesce(state, '') <> 'running'")
    s2["group_requests"] = s1["group_requests"].withColumn("state", F.lit("Stopped"))
    both = {k: s1[k].withColumn("snapshot_id", F.lit(1)).unionByName(s2[k].withColumn("snapshot_id", F.lit(2)))
            for k in s1}
    return s1, s2, both


def _same(scoped, per1, per2):
    want = per1.withColumn("snapshot_id", F.lit(1)).unionByName(per2.withColumn("snapshot_id", F.lit(2)))
    cols = sorted(scoped.columns)
    assert cols == sorted(want.columns)
    def rows(df):
        return sorted((tuple(r) for r in df.select(*cols).collect()),
                      key=lambda t: tuple((x is None, str(x)) for x in t))
    a, b = rows(scoped), rows(want)
    assert len(a) == len(b) and a == b


def _comp(t):
    return t["processors"].select(*([c for c in SCOPE if c in t["processors"].columns]), "id", "group_id",
                                  F.lit("PROCESSOR").alias("kind"))


def _initial(t):
    return t["processors"].select(*([c for c in SCOPE if c in t["processors"].columns]), "id",
                                  F.lit(0).cast("bigint").alias("version"), F.col("name").alias("config"))


def _maps(t, sc):
    props = t["properties"].groupBy(*sc, F.col("processor_id").alias("id")).agg(
        F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("properties"))
    auto = t["auto"].groupBy(*sc, F.col("processor_id").alias("id")).agg(F.collect_list("value").alias("auto_terminated"))
    out = changes.config_update_maps(t["processors"].select(*sc, "id").join(props, [*sc, "id"], "left").join(
        auto, [*sc, "id"], "left"), t["updates"], sc)
    return out.withColumn("properties", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("properties")))))


CASES = {
    "delete_preflight": lambda t, sc=(): changes.delete_preflight(t["deletes"], changes.delete_facts(
        t["processors"], t["connections"], t["groups"], t["ports"], t["queue"], sc), sc),
    "connection_validate": lambda t, sc=(): changes.connection_validate(t["requests"].withColumn(
        "relationships", F.split("relationships", ";")), _comp(t), sc),
    "pipeline_spec_expand": lambda t, sc=(): changes.pipeline_spec_expand(t["specs"].drop("config"), sc),
    "pipeline_summary": lambda t, sc=(): changes.pipeline_summary(
        changes.pipeline_spec_expand(t["specs"].drop("config"), sc), t["names"], sc),
    "versioned_apply": lambda t, sc=(): versioned.versioned_apply(t["commands"], _initial(t), 5, ["UPDATE"], ["config"], sc),
    "versioned_table": lambda t, sc=(): versioned.versioned_table(versioned.versioned_apply(
        t["commands"], _initial(t), payload=["config"], scope=sc), _initial(t), ["config"], sc),
    "config_status": lambda t, sc=(): changes.config_update(t["properties"], t["updates"], t["processors"], t["auto"], sc)[0],
    "config_update": lambda t, sc=(): changes.config_update(t["properties"], t["updates"], t["processors"], t["auto"], sc)[1],
    "config_update_maps": lambda t, sc=(): _maps(t, list(sc)),
    "state_apply": lambda t, sc=(): changes.state_apply(t["states"], t["processors"], t["ports"], sc),
    "group_state_table": lambda t, sc=(): changes.group_state_apply(
        t["groups"].sparkSession, t["group_requests"], t["processors"], t["ports"], sc),
    "group_state_list": lambda t, sc=(): changes.group_state_apply(
        t["groups"].sparkSession, [("pg-n7", "running"), ("pg-n3", "stopped")], t["processors"], t["ports"], sc),
    "lint_report": lambda t, sc=(): lint.lint_report(t["groups"], t["processors"], t["connections"], sc),
    "pipeline_tree": lambda t, sc=(): tree.pipeline_tree(t["groups"], sc),
    "pipeline_list": lambda t, sc=(): tree.pipeline_list(t["groups"], sc),
    "effective_parameters": lambda t, sc=(): tree.effective_parameters(t["groups"], t["parameters"], sc),
    "group_status": lambda t, sc=(): status.group_status(
        t["groups"], t["processors"], t["connections"], t["queue"], sc),
    "backpressure_check": lambda t, sc=(): status.backpressure_check(t["connections"], t["queue"], sc),
    "flowfile_expiry": lambda t, sc=(): status.flowfile_expiry(t["connections"], t["queue"],
                                                               "1999-06-01 00:00:00", sc),
    "component_roles": lambda t, sc=(): graph.component_roles(_comp(t), t["connections"], t["rels"], sc),
    "error_paths": lambda t, sc=(): graph.error_paths(t["connections"], t["rels"], t["queue"], sc),
    "unrouted_failures": lambda t, sc=(): graph.unrouted_failures(t["processors"], t["connections"], t["rels"], sc),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_scoped_equals_per_snapshot(spark, snaps, name):
    s1, s2, both = snaps
    fn = CASES[name]
    _same(fn(both, SCOPE), fn(s1), fn(s2))
