"""delete_apply: connections are shuffled once a side by a key that sorts as a number; their input is derived once."""

from conftest import SF001
from flowlake.operators import deletes
from flowlake.sources.tables import Estate
from pyspark.sql import functions as F


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_connections_settle_in_one_shuffle_a_side(spark):
    key = deletes._key(F.lit("connection"), F.col("id"))
    tries = spark.createDataFrame(
        [("a", 5, 0), ("a", 3, 0), ("a", 1, 7), ("a", 2, None), ("q", 1, 0), ("gone", 1, 0), ("old", 4, 0), ("old", 6, 2)],
        "id string, seq long, expected_version long").select(key, "*")
    connections = spark.createDataFrame([("a", 0), ("a", 0), ("q", 0), ("old", 1), ("old", 2), ("unasked", 0), (None, 0)],
                                        "id string, version long").select(key, "*")
    queue = spark.createDataFrame([("q",), ("q",), ("gone",), (None,)], "connection_id string")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = deletes._connections_settled(tries, connections, queue)
        # the queue's count, the connections with it, the tries
        assert _plan(links).count("Exchange hashpartitioning") == 3
        got = {tuple(r) for r in links.select("id", "version", "queued", "t").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert got == {("a", 0, 0, 3), ("q", 0, 2, deletes.NEVER), ("old", 2, 0, 6)}


def test_kept_view_is_read_from_files_with_the_same_rows(spark):
    plain, kept = Estate.load(spark, SF001), Estate.load(spark, SF001)
    kept.fx.keep("fx_transfer")
    for name in ("connections", "delete_batch", "late_queue"):
        a, b = getattr(plain, name), getattr(kept, name)
        assert "lineitem" in _plan(a) and "lineitem" not in _plan(b)
        assert a.schema == b.schema and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
