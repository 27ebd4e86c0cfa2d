"""Disk: written tables leave no shuffle files, deletes of many rows go in rounds."""

import os
import time

from flowlake import session
from flowlake.operators import deletes
from flowlake.session import discard, written
from pyspark.sql import functions as F


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def _folder(spark):
    return set(os.listdir(session.ensure_checkpoint_dir(spark).removeprefix("file:")))


def _texts(df):
    return sorted(map(str, df.collect()))


def test_written_leaves_no_shuffle_files(spark):
    was = spark.conf.get(session.SHUFFLE_CLEANUP)
    before = _shuffle_files(spark)
    table = written(spark.range(1000).repartition(4, "id").groupBy(F.col("id") % 7).count(), "told")
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == was and table.count() == 7
    discard(table)
    assert os.path.basename(table._written_to) not in _folder(spark)


def test_deletes_of_rounds_equal_those_of_one(spark, monkeypatch):
    groups = spark.createDataFrame([("g", None), ("h", "g"), (None, "g")], "id string, parent_id string")
    procs = spark.createDataFrame([(f"p{i}", "h" if i % 2 else "g", "STOPPED" if i % 5 else "RUNNING", 0) for i in range(20)] + [(None, "g", "STOPPED", 0)],
                                  "id string, group_id string, run_status string, version long")
    conns = spark.createDataFrame([(f"c{i % 25}" if i else None, "h", f"p{i % 20}", f"p{(i * 7) % 20}", i % 2) for i in range(30)],
                                  "id string, group_id string, source_id string, destination_id string, version long")
    ports = spark.createDataFrame([("in", "h", "INPUT_PORT", "STOPPED"), ("out", "g", "OUTPUT_PORT", "RUNNING")],
                                  "id string, group_id string, kind string, run_status string")
    queue = spark.createDataFrame([("c3",), ("c3",), ("c9",), (None,)], "connection_id string")
    cmds = spark.createDataFrame(
        [(i, "connection", f"c{i}", 1 if i % 4 else 0) for i in range(27)] + [(i, "connection", f"c{i}", 0) for i in range(30, 50)]
        + [(20 + i, "processor", f"p{i}", 0) for i in range(21)] + [(60, "input_port", "in", 0), (61, "group", "h", 0), (62, "group", "g", 0)]
        + [(5, "connection", None, 0), (None, "connection", "c4", 0), (5, "widget", "c4", None), (6, None, "c4", 0)],
        "seq long, kind string, target_id string, expected_version long")
    want = _texts(deletes.delete_apply(cmds, procs, conns, groups, ports, queue))
    assert len(want) == cmds.count()
    monkeypatch.setattr(session, "ROUND_ROWS", 40)
    before = _folder(spark)
    assert _texts(deletes.delete_apply(cmds, procs, conns, groups, ports, queue)) == want
    kept = {n.rsplit("-", 1)[0] for n in _folder(spark) - before}
    assert "delete-told" in kept and not kept & {"delete-connections", "delete-links"}
