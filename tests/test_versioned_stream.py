"""H2 on a stream: equal to the batch fold, whatever nulls, sizes and order of arrival."""

import datetime as dt
import random

import pytest
from flowlake.operators import versioned
from flowlake.session import shared_path
from flowlake.streaming import streams
from flowlake.streaming.versioned_stream import PROVIDER, versioned_apply_stream

BIG = 2 ** 53 + 1
SCHEMA = "seq long, target_id string, op string, expected_version long, note string, size long, at timestamp"
START = dt.datetime(2024, 1, 1)


def stream_of(spark, parts):
    """A stream of the rows of each part, one file and one micro-batch a part."""
    path = shared_path(spark, "commands")
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/p{i:03d}")
    return (spark.readStream.schema(spark.createDataFrame([], SCHEMA).schema).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", "1").parquet(path))


def outcomes(df):
    columns = ["seq", "target_id", "op", "expected_version", "outcome", "present_after", "version_after"]
    return sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect())))


def test_whole_numbers_stay_exact_and_null_seq_runs_first(spark):
    rows = [(1, "a", "UPDATE", BIG, "x", BIG, None), (2, "a", "update", None, None, None, None), (None, "a", "UPDATE", BIG + 1, "y", 1, None),
            (3, "b", "CREATE", None, "é", 2, None), (4, "b", "DELETE", 0, None, 3, None), (5, None, "UPDATE", 1, "lost", 4, None),
            (6, "c", None, 1, "", 5, None), (7, "c", "DELETE", 1, "z", 6, None)]
    initial = spark.createDataFrame([("a", BIG), (None, 1)], "id string, version long")
    got = streams.drain(versioned_apply_stream(stream_of(spark, [rows]), initial, payload=["note", "size"]), "h2")
    batch = versioned.versioned_apply(spark.createDataFrame(rows, SCHEMA), initial, payload=["note", "size"])
    assert outcomes(got) == outcomes(batch)
    updated = [r for r in got.collect() if r.outcome == "updated"]
    assert [(r.expected_version, r.version_after) for r in updated] == [(BIG, BIG + 1)]
    assert sorted((str(r.seq), r.note, r.size) for r in got.collect()) == sorted((str(r[0]), r[4], r[5]) for r in rows)


@pytest.mark.parametrize("seed", range(2))
def test_shuffled_micro_batches_give_the_batch_result(spark, seed):
    rnd = random.Random(seed)
    rows = [(BIG + i, rnd.choice(["hot", "hot", "a", "b", "c"]), rnd.choice(["CREATE", "UPDATE", "UPDATE", "DELETE"]),
             rnd.choice([None, 0, 1, 2]), str(i), i, START + dt.timedelta(seconds=i)) for i in range(200)]
    initial = spark.createDataFrame([("hot", 0), ("a", 2)], "id string, version long")
    shuffled = sorted(rows, key=lambda r: r[0] + rnd.randint(0, 80))  # up to 80 seconds late
    # the last one moves the watermark past all others
    last = (BIG + 999, "end", "CREATE", None, "", 0, START + dt.timedelta(hours=9))
    stream = stream_of(spark, [shuffled[i:i + 40] for i in range(0, 200, 40)] + [[last]])
    got = streams.drain(versioned_apply_stream(stream, initial, event_time="at", watermark="120 seconds"), "h2-time")
    batch = versioned.versioned_apply(spark.createDataFrame(rows, SCHEMA), initial)
    assert outcomes(got) == outcomes(batch)


def test_commands_behind_the_watermark_are_told(spark):
    rows = [(i, "a", "UPDATE", 0, None, None, START + dt.timedelta(seconds=s)) for i, s in enumerate([0, 5000, 9000, 1])]
    initial = spark.createDataFrame([("a", 0)], "id string, version long")
    stream = versioned_apply_stream(stream_of(spark, [[r] for r in rows]), initial, event_time="at", watermark="10 seconds")
    with pytest.raises(RuntimeError, match="came later"):
        streams.drain(stream, "h2-late")


def test_another_state_store_is_an_error(spark):
    before = spark.conf.get(PROVIDER, "")
    try:
        spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
        with pytest.raises(RuntimeError, match="state store"):
            versioned_apply_stream(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "id string, version long"))
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)
