"""Streams drain to the batch result, dedupe overlapping files, resume from checkpoint; sinks partition."""

import os
import shutil

from pyspark.sql import functions as F

from conftest import SF001
from flowlake.plans.catalog import QUERIES
from flowlake.operators.route import relationship_route, write_by_relationship
from flowlake.sources.fixtures import view_over
from flowlake.streaming import streams


def test_overlapping_parts_and_restart(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    n_err = ev.where("event_type = 'error'").count()
    # two part files that overlap on event ids 400..599
    ev.where("event_id < 600").coalesce(1).write.parquet(str(tmp_path / "p1"))
    ev.where("event_id >= 400").coalesce(1).write.parquet(str(tmp_path / "p2"))
    for i, d in enumerate(["p1", "p2"]):
        f = [x for x in os.listdir(tmp_path / d) if x.endswith(".parquet")][0]
        shutil.copy(tmp_path / d / f, src / f"events-{i}.parquet")
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    s = streams.read_event_stream(spark, str(src), max_files_per_trigger=1)
    out = streams.drain(streams.provenance_stream(view_over("fx_provenance", events=s), "1 hour", event_type="ERROR"), "t", sink, ck)
    assert out.count() == n_err
    assert out.select("event_id").distinct().count() == n_err
    # restart from the checkpoint with no new files: nothing is added
    s2 = streams.read_event_stream(spark, str(src))
    out2 = streams.drain(streams.provenance_stream(view_over("fx_provenance", events=s2), "1 hour", event_type="ERROR"), "t", sink, ck)
    assert out2.count() == n_err


def test_bulletin_stream_equals_batch_feed_filter(spark):
    got = QUERIES["bulletin_stream"](spark, SF001).count()
    from flowlake.sources.tables import Estate
    want = Estate.load(spark, SF001).bulletins.where("group_id = 'pg-n7'").count()
    assert got == want


def test_write_by_relationship(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, 50), (3, None)], "k int, v int")
    routed = relationship_route(df, {"small": F.col("v") < 10, "big": F.col("v") > 40})
    out = str(tmp_path / "routed")
    write_by_relationship(routed, out)
    dirs = sorted(d for d in os.listdir(out) if d.startswith("relationship="))
    assert dirs == ["relationship=big", "relationship=small", "relationship=unmatched"]
    back = spark.read.parquet(out)
    assert sorted((r["k"], r["relationship"]) for r in back.collect()) == [(1, "small"), (2, "big"), (3, "unmatched")]


def test_flow_docs_stream_equals_batch(spark, tmp_path):
    from flowlake.operators import canvas
    from flowlake.sources.flowdocs import build_flow_docs, read_flow_docs, write_flow_docs
    from flowlake.sources.tables import Estate
    e = Estate.load(spark, SF001)
    path = str(tmp_path / "docs")
    write_flow_docs(build_flow_docs(e.groups, e.processors, e.connections, e.ports), path)
    docs = read_flow_docs(spark, path, streaming=True)
    procs = canvas.canvas_explode(docs)["processors"].select("id", "group_id", "run_status")
    out = streams.drain(procs, "docs", str(tmp_path / "sink"), str(tmp_path / "ck"))
    assert sorted(tuple(r) for r in out.collect()) == sorted(
        tuple(r) for r in e.processors.select("id", "group_id", "run_status").collect())


def test_stream_routed_sink(spark, tmp_path):
    from flowlake.operators.route import write_stream_by_relationship
    src = tmp_path / "ev"
    src.mkdir()
    f = [x for x in os.listdir(SF001) if x == "events.parquet"][0]
    shutil.copy(os.path.join(SF001, f), src / "events.parquet")
    s = streams.read_event_stream(spark, str(src))
    routed = relationship_route(s, {"errors": F.col("event_type") == "error", "big": F.col("value") > 40},
                                auto_terminated=["big"])
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    q = write_stream_by_relationship(routed, out, ck)
    q.awaitTermination()
    back = spark.read.parquet(out)
    batch = relationship_route(spark.read.parquet(str(src)),
                               {"errors": F.col("event_type") == "error", "big": F.col("value") > 40},
                               auto_terminated=["big"])
    assert back.count() == batch.count()
    assert {r[0] for r in back.select("relationship").distinct().collect()} == {"errors", "unmatched"}
    # restart: nothing new
    q2 = write_stream_by_relationship(routed, out, ck)
    q2.awaitTermination()
    assert spark.read.parquet(out).count() == batch.count()


def test_late_events_are_told(spark, tmp_path):
    """An event far behind the watermark is dropped by Spark; drain says so instead of returning too little."""
    import datetime as dt

    import pytest
    schema = "event_id long, event_time timestamp, event_type string, component_id string"
    src, at = str(tmp_path / "src"), dt.datetime(2024, 1, 1, 12)
    hour = dt.timedelta(hours=1)
    for rows in ([(1, at, "A", "p")], [(2, at + 48 * hour, "A", "p")], [(3, at + 47 * hour, "A", "p"), (4, at - hour, "A", "p")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = streams.provenance_stream(spark.readStream.schema(schema).parquet(src), "2 hours")
        args = (stream, "late", str(tmp_path / "sink"), str(tmp_path / "ck"))
        if rows[-1][0] == 4:
            with pytest.raises(RuntimeError, match="1 rows came later"):
                streams.drain(*args)
        else:
            out = streams.drain(*args)
    assert {r["event_id"] for r in out.collect()} <= {1, 2, 3}
