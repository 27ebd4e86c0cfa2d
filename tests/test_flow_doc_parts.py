"""Flow documents in parts: no line holds a whole group, and every reader sees whole documents."""

import pytest
from pyspark.sql import functions as F

from flowlake import schemas as S
from flowlake.operators import canvas, lint
from flowlake.sources.flowdocs import PART_ENTRIES, build_flow_docs, read_flow_docs, write_flow_docs
from flowlake.streaming import streams

N = 3 * PART_ENTRIES + 7
LINT = ["group_id", "rule", "rule_order", "processor_id", "suggestion", "processor_count", "connection_count"]


def _texts(df, *cols):
    return sorted(map(str, df.select(*cols).collect()))


@pytest.fixture(scope="module")
def estate(spark):
    # "twice" are two rows of one id, that is two documents; null ids are documents without members
    groups = spark.createDataFrame(
        [("root", None, "Root"), ("big", "root", "Big"), ("twice", "root", "T"), ("twice", "root", "T"), (None, "root", "lost"),
         ("none", "big", None)], "id string, parent_id string, name string")
    group = F.when(F.col("id") % 9 == 0, "twice").when(F.col("id") % 11 == 0, "gone").when(F.col("id") % 13 == 0, None).otherwise("big")
    ids = spark.range(N).withColumn("group_id", group)
    procs = ids.select(
        F.when(F.col("id") % 50 != 1, F.concat(F.lit("p"), F.col("id") % 1000)).alias("id"), "group_id", F.lit("n").alias("name"),
        F.lit("T").alias("type"), F.when(F.col("id") % 3 == 0, "STOPPED").otherwise("RUNNING").alias("run_status"),
        F.lit(1).cast("long").alias("version"),
        F.when(F.col("id") % 7 == 0, F.array(F.lit("e1"), F.lit("e2"))).alias("validation_errors"))
    # all rows equal but for the ends: every third one has the same ends, and so the same hash
    end = F.when(F.col("id") % 3 == 0, "p2").otherwise(F.concat(F.lit("p"), F.col("id")))
    conns = ids.select(F.lit("c").alias("id"), "group_id", end.alias("source_id"), F.lit("").alias("destination_id"),
                       F.lit(1).cast("long").alias("bp_objects"), F.lit("1 GB").alias("bp_size"), F.lit("0 sec").alias("expiration"))
    ports = spark.createDataFrame([("in", "big", "INPUT_PORT", "i", "RUNNING"), ("out", "twice", "OUTPUT_PORT", "o", None)],
                                  "id string, group_id string, kind string, name string, run_status string")
    return groups, procs, conns, ports


@pytest.fixture(scope="module")
def path(spark, estate, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "docs")
    write_flow_docs(build_flow_docs(*estate), path)
    return path


def _doubled(estate, table):
    """The member rows that documents hold: those of group rows, once for each of these."""
    return table.join(estate[0].select(F.col("id").alias("group_id")), "group_id")


def test_no_line_holds_more_than_a_part(spark, path):
    docs = read_flow_docs(spark, path)
    sizes = sum((canvas.list_size(F.col(f"processGroupFlow.flow.{k}")) for k in S.FLOW_KINDS), F.lit(0))
    assert 0 < docs.agg(F.max(sizes)).first()[0] <= PART_ENTRIES


def test_members_counts_and_groups_are_whole(spark, estate, path):
    groups, procs, conns, ports = estate
    docs = read_flow_docs(spark, path)
    parts = canvas.canvas_explode(docs)
    for kind, table, cols in (("processors", procs, ["id", "group_id", "run_status", "validation_errors"]),
                              ("connections", conns, ["id", "group_id", "source_id", "bp_objects"])):
        assert _texts(parts[kind], *cols) == _texts(_doubled(estate, table), *cols)
    assert _texts(canvas.document_groups(docs), "id", "parent_id", "name") == _texts(groups, "id", "parent_id", "name")
    big, twice = (procs.where(F.col("group_id") == g).count() for g in ("big", "twice"))
    rows = canvas.flow_counts(docs).select("group_id", "n_processors", "n_connections", "n_process_groups", "n_output_ports").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [("root", 0, 0, 4, 0), ("big", big, big, 1, 0), ("twice", twice, twice, 0, 1), ("twice", twice, twice, 0, 1),
         ("none", 0, 0, 0, 0), (None, 0, 0, 0, 0)], key=str)
    assert [r["root_id"] for r in canvas.root_from_documents(docs).collect()] == ["root"]
    assert _texts(canvas.pipeline_list_from_documents(docs), "id", "parent") == sorted(
        f"Row(id={i!r}, parent={p!r})" for i, p in
        [("root", "root"), ("big", "Root"), ("twice", "Root"), ("twice", "Root"), (None, "Root")])


def test_lint_of_parts_equals_the_report(spark, estate, path):
    groups, procs, conns, _ = estate
    docs = read_flow_docs(spark, path)
    once = lint.lint_report(groups.where("id <> 'twice'"), procs.where("group_id = 'big'"), conns)
    twice = lint.lint_report(groups.where("id = 'twice'").limit(1), procs.where("group_id = 'twice'"), conns)
    lost = spark.createDataFrame([(None, "no_processors", 0, None, lint.T.MSG_NO_PROCESSORS, None, None)], once.select(*LINT).schema)
    want = _texts(once.select(*LINT).unionByName(twice.select(*LINT)).unionByName(twice.select(*LINT)).unionByName(lost), *LINT)
    assert any("disconnected" in x for x in want)
    assert _texts(lint.lint_documents(docs), *LINT) == want
    lines = streams.drain(lint.lint_lines(read_flow_docs(spark, path, streaming=True)), "parts")
    assert _texts(lint.lint_settled(lines), *LINT) == want


def test_stream_of_parts_needs_settling(spark, path):
    with pytest.raises(Exception, match="documents in parts need a batch"):
        streams.drain(lint.lint_documents(read_flow_docs(spark, path, streaming=True)), "parts")


def test_whole_documents_stay_narrow_on_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "d.json").write_text(
        '{"id": "g", "processGroupFlow": {"id": "g", "flow": {"processors": [{"id": "p", "status": {"runStatus": "STOPPED"}}]}}}\n')
    stream = read_flow_docs(spark, str(tmp_path / "in"), streaming=True)
    got = streams.drain(lint.lint_documents(stream), "whole").collect()
    assert sorted(r["rule"] for r in got) == ["disconnected", "stopped"]
    assert streams.drain(canvas.flow_counts(stream), "counts").first()["n_processors"] == 1
