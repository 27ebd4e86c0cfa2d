"""Skew check: one key holding about half of the rows.

Builds a queue and a command log from lineitem where every row with
l_returnflag = 'N' (about half of them) belongs to one hot key, then reports how
many rows the busiest task gets:

* ``window``: a per-key window (hash partitioning on the key): the hot key's
  rows all land in one partition;
* ``ranked``: the range-partitioned layout used by ``position_within`` and
  ``versioned_apply``: the hot key is cut across partitions.

It also checks that both give the same positions.  Prints one JSON line.
Usage: python scripts/skew_check.py [sf_dir] [partitions]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def _max_share(df):
    sizes = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes), sum(sizes), len(sizes)


def main():
    from flowlake.functions.ranking import position_within, sorted_checkpoint
    from flowlake.operators.versioned import versioned_apply
    from flowlake.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    parts = int(sys.argv[2]) if len(sys.argv) > 2 else 16
    spark = build_session(shuffle_partitions=parts)
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    key = F.when(F.col("l_returnflag") == "N", F.lit("hot")).otherwise(
        F.concat(F.lit("conn-"), F.col("l_suppkey").cast("string")))
    queue = li.select(key.alias("connection_id"), F.col("l_shipdate").alias("queued_at"),
                      F.concat_ws("-", "l_orderkey", "l_linenumber").alias("flowfile_uuid"))
    out = {"sf": sf, "partitions": parts, "rows": queue.count(),
           "hot_rows": queue.where(F.col("connection_id") == "hot").count()}

    win = queue.repartition(parts, "connection_id")
    out["window_max_task_rows"], _, _ = _max_share(win)
    ck = sorted_checkpoint(queue, ["connection_id", "queued_at", "flowfile_uuid"], parts)
    out["ranked_max_task_rows"], _, out["ranked_tasks"] = _max_share(ck)

    t = time.time()
    got = position_within(queue, ["connection_id"], ["queued_at", "flowfile_uuid"], "pos", parts)
    w = Window.partitionBy("connection_id").orderBy("queued_at", "flowfile_uuid")
    want = queue.withColumn("pos", F.row_number().over(w))
    diff = got.select("connection_id", "flowfile_uuid", "pos").exceptAll(
        want.select("connection_id", "flowfile_uuid", "pos")).count()
    out["positions_equal"] = diff == 0
    out["position_sec"] = round(time.time() - t, 2)

    cmds = li.select(F.monotonically_increasing_id().alias("seq"), key.alias("target_id"),
                     F.when(F.col("l_linestatus") == "O", F.lit("UPDATE")).otherwise(F.lit("CREATE")).alias("op"),
                     (F.col("l_linenumber") - 1).cast("bigint").alias("expected_version"))
    cmds = cmds.checkpoint(eager=True)  # fix the generated ids before they are read twice
    initial = spark.createDataFrame([("hot", 0)], "id string, version bigint")
    t = time.time()
    res = versioned_apply(cmds, initial, parts)
    out["versioned_outcomes"] = {r[0]: r[1] for r in res.groupBy("outcome").count().collect()}
    out["versioned_sec"] = round(time.time() - t, 2)

    # brute force: the same fold as a plain loop on the driver (check only)
    from collections import Counter

    from flowlake.operators.versioned import step
    state = {"hot": (True, 0)}
    want = Counter()
    for r in sorted(cmds.collect(), key=lambda r: (r["target_id"], r["seq"])):
        p, v = state.get(r["target_id"], (False, None))
        o, p, v = step(r["op"], r["expected_version"], p, v)
        state[r["target_id"]] = (p, v)
        want[o] += 1
    out["versioned_equal_loop"] = dict(want) == out["versioned_outcomes"]
    print(json.dumps(out))


if __name__ == "__main__":
    main()
