"""The sink by batch ids: replayed batches add nothing; late events are settled once."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.operators.route import relationship_route
from flowlake.streaming import batch_sink

EVENTS = "event_id long, event_time timestamp_ntz, event_type string, component_id string"


def test_a_batch_replayed_after_a_crash_adds_nothing(spark, tmp_path, monkeypatch):
    src, path, ck = (str(tmp_path / d) for d in ("src", "sink", "ck"))
    os.mkdir(src)
    schema = "k int, v int"
    stream = relationship_route(spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(src),
                                {"small": F.col("v") < 10, "even": F.col("v") % 2 == 0})
    want = []

    def feed(lo):
        rows = [(k, k % 20 if k % 7 else None) for k in range(lo, lo + 50)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        for k, v in rows:
            hits = [r for r, ok in (("small", v is not None and v < 10), ("even", v is not None and v % 2 == 0)) if ok]
            want.extend((k, v, r) for r in hits or ["unmatched"])

    def rows():
        got = batch_sink.read_batches(spark, path, stream.schema)
        return sorted(((r.k, r.v, r.relationship) for r in got.collect()), key=str)

    feed(0)
    batch_sink.write_batches(stream, path, ck, ["relationship"]).awaitTermination()
    before = rows()
    assert before == sorted(want, key=str)
    feed(50)
    commit = batch_sink._commit
    monkeypatch.setattr(batch_sink, "_commit", lambda *a: 1 / 0)  # ends between data and manifest
    with pytest.raises(Exception, match="ZeroDivisionError"):
        batch_sink.write_batches(stream, path, ck, ["relationship"]).awaitTermination()
    assert rows() == before  # unfinished rows are there, but not read
    assert spark.read.parquet(f"{path}/rows").count() > len(before)

    def then_lost(entry, place):  # ends between manifest and checkpoint
        commit(entry, place)
        raise RuntimeError("lost")

    monkeypatch.setattr(batch_sink, "_commit", then_lost)
    with pytest.raises(Exception, match="lost"):
        batch_sink.write_batches(stream, path, ck, ["relationship"]).awaitTermination()
    monkeypatch.setattr(batch_sink, "_commit", commit)
    for _ in range(2):
        batch_sink.write_batches(stream, path, ck, ["relationship"]).awaitTermination()
        assert rows() == sorted(want, key=str)
    assert spark.read.parquet(f"{path}/rows").count() == len(want)
    assert batch_sink.manifest(spark, path).agg(F.sum("n_rows")).first()[0] == len(want)


def test_late_events_arrive_once(spark, tmp_path):
    src, path, ck = (str(tmp_path / d) for d in ("src", "sink", "ck"))
    rnd, start = random.Random(5), dt.datetime(2024, 3, 1)
    events = [(i, start + dt.timedelta(hours=rnd.randrange(24 * 40)), "A", f"p{i % 3}") for i in range(300)]
    events += [(None, start, "A", "p0"), (900, None, "A", "p1"), (None, None, None, None)]
    schema = T._parse_datatype_string(EVENTS)
    late, newest, seen = 0, None, set()
    for part in range(4):
        rows = rnd.choices(events, k=200) if part < 3 else events * 2
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        batch_sink.settle_events(stream, path, ck, delay="2 hours").awaitTermination()
        new = set(rows) - seen
        late += sum(1 for r in new if newest and r[1] and r[1] < newest - dt.timedelta(hours=2))
        seen |= new
        newest = max([newest or start, *(r[1] for r in seen if r[1])])
        got = [tuple(r) for r in batch_sink.settled_events(spark, path, schema).collect()]
        assert sorted(got, key=str) == sorted(seen, key=str)
    told = batch_sink.manifest(spark, path).agg(F.sum("n_rows"), F.sum("n_late")).first()
    assert tuple(told) == (len(events), late) and late > 50


def test_only_the_dates_of_a_batch_are_read(spark, tmp_path):
    path = str(tmp_path / "sink")
    schema = T._parse_datatype_string(EVENTS)
    rows = [(i, dt.datetime(2024, 3, 1 + i % 20), "A", "p") for i in range(100)]
    src = str(tmp_path / "src")
    spark.createDataFrame(rows, schema).write.parquet(src)
    batch_sink.settle_events(spark.readStream.schema(schema).parquet(src), path, str(tmp_path / "ck")).awaitTermination()
    old = batch_sink.read_batches(spark, path, T.StructType([*schema.fields, T.StructField("event_date", T.DateType())]))
    plan = old.where(F.col("event_date").isin([dt.date(2024, 3, 2)]))._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("PartitionFilters: [")[1:] if "event_date" in line.split("]")[0]]
    assert filters


def test_names_of_the_sink_are_refused(spark, tmp_path):
    stream = spark.readStream.schema("sink_batch int").parquet(str(tmp_path))
    with pytest.raises(ValueError, match="sink_batch"):
        batch_sink.write_batches(stream, str(tmp_path / "a"), str(tmp_path / "b"))
