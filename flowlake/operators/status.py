"""Status roll-up and queue rules.

Facts (processors, connections, queued items) are aggregated to one row per
group or connection *before* they meet the group tree, and the tree is summed
up without a closure, so no step has more rows than there are groups.

``scope`` (for example ``["snapshot_id"]``) is added to every join key and
grouping and leads the output columns.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import written
from . import tree

METRICS = ["processors", "running", "stopped", "disabled", "invalid",
           "connections", "queued_items", "queued_bytes"]


def own_status(groups: DataFrame, processors: DataFrame, connections: DataFrame,
               queue: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Per group, its own counts: processors by run state, connections, queue load."""
    gkey = [*scope, "group_id"]
    rs = F.col("run_status")
    p = processors.groupBy(*gkey).agg(
        F.count(F.lit(1)).alias("processors"),
        F.count_if(rs == "RUNNING").alias("running"),
        F.count_if(rs == "STOPPED").alias("stopped"),
        F.count_if(rs == "DISABLED").alias("disabled"),
        F.count_if(F.coalesce(F.size("validation_errors"), F.lit(0)) > 0).alias("invalid"))
    c = connections.groupBy(*gkey).agg(F.count(F.lit(1)).alias("connections"))
    q = queue.groupBy(*gkey).agg(F.count(F.lit(1)).alias("queued_items"),
                                 F.sum("size_bytes").cast("bigint").alias("queued_bytes"))
    out = groups.select(*scope, F.col("id").alias("group_id"))
    for part in (p, c, q):
        out = out.join(part, gkey, "left")
    return out.select(*gkey, *[F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in METRICS])


def group_status(groups: DataFrame, processors: DataFrame, connections: DataFrame,
                 queue: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Own counts and counts rolled up over each group's subtree (``tree.subtree_sums``).

    Raises ``ValueError`` if parent links form a cycle.
    """
    scope = list(scope)
    own = written(own_status(groups, processors, connections, queue, scope), "own-status")
    totals = tree.subtree_sums(groups, own.withColumnRenamed("group_id", "id"), METRICS, scope)
    return own.select(*scope, "group_id", *[F.col(m).alias(f"own_{m}") for m in METRICS]).join(
        totals.select(*scope, F.col("id").alias("group_id"), *[F.col(m).alias(f"total_{m}") for m in METRICS]), [*scope, "group_id"])


def queue_load(queue: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Queued items and bytes per connection (partial aggregation before the shuffle)."""
    return queue.groupBy(*scope, "connection_id").agg(
        F.count(F.lit(1)).alias("queued_items"),
        F.sum("size_bytes").cast("bigint").alias("queued_bytes"))


def backpressure_check(connections: DataFrame, queue: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Connections at or over their object or size threshold.

    Missing thresholds take the new-connection defaults (10000 items, 1 GB).
    """
    load = queue_load(queue, scope)
    objs = F.coalesce(F.col("bp_objects"), F.lit(T.DEFAULT_BP_OBJECTS)).cast("bigint")
    size = T.parse_data_size(F.coalesce(F.col("bp_size"), F.lit(T.DEFAULT_BP_SIZE)))
    out = connections.withColumnRenamed("id", "connection_id").join(load, [*scope, "connection_id"]).select(
        *scope, "connection_id", "group_id", "queued_items", "queued_bytes",
        objs.alias("bp_objects"), size.alias("bp_bytes"))
    out = out.withColumn("over_objects", F.col("queued_items") >= F.col("bp_objects")) \
        .withColumn("over_size", F.coalesce(F.col("queued_bytes") >= F.col("bp_bytes"), F.lit(False)))
    return out.where(F.col("over_objects") | F.col("over_size"))


def _ts_ntz(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp_ntz(F.lit(str(as_of)))


def flowfile_expiry(connections: DataFrame, queue: DataFrame, as_of,
                    scope: Sequence[str] = ()) -> DataFrame:
    """Queued items on expiring connections, flagged when older than the expiry.

    ``0 sec`` means never; ``as_of`` is an argument, never the wall clock.
    """
    ms = T.parse_duration_ms(F.coalesce(F.col("expiration"), F.lit(T.DEFAULT_EXPIRATION)))
    conn = connections.select(*scope, F.col("id").alias("connection_id"), ms.alias("expiration_ms")) \
        .where(F.col("expiration_ms") > 0)
    cutoff = F.timestamp_add("MILLISECOND", -F.col("expiration_ms"), _ts_ntz(as_of))
    return queue.join(conn, [*scope, "connection_id"]).select(
        *scope, "connection_id", "flowfile_uuid", "queued_at", "expiration_ms",
        (F.col("queued_at") < cutoff).alias("expired"))
