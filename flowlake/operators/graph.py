"""Component roles and error paths over the connection graph.

Degrees and relationship counts are plain aggregates keyed by component id;
a component with a very large fan-out is reduced map-side before the shuffle.
``scope`` (for example ``["snapshot_id"]``) is added to every key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAILURE = "failure"


def component_roles(components: DataFrame, connections: DataFrame,
                    relationships: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Degree counts and role flags per component (a step can hold several roles).

    * ``is_source``: outgoing edges only; ``is_destination``: incoming only;
    * ``is_transform``: both; ``is_unconnected``: neither;
    * ``is_router``: more than one distinct relationship on its outgoing edges.
    A self-loop counts as one outgoing and one incoming edge.
    """
    # both ends from one scan, both degrees from one aggregation
    scope = list(scope)
    ends = connections.select(*scope, F.explode(F.array(
        F.struct(F.col("source_id").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("destination_id").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("e"))
    degrees = ends.groupBy(*scope, F.col("e.id").alias("id")).agg(
        F.sum("e.o").alias("out_degree"), F.sum("e.i").alias("in_degree"))
    rels = relationships.join(connections.select(*scope, F.col("id").alias("connection_id"), "source_id"),
                              [*scope, "connection_id"]) \
        .groupBy(*scope, F.col("source_id").alias("id")) \
        .agg(F.count_distinct("relationship").alias("out_relationships"))
    df = components.select(*scope, "id", "group_id", "kind")
    for part in (degrees, rels):
        df = df.join(part, [*scope, "id"], "left")
    o = F.coalesce("out_degree", F.lit(0)).cast("bigint")
    i = F.coalesce("in_degree", F.lit(0)).cast("bigint")
    r = F.coalesce("out_relationships", F.lit(0)).cast("bigint")
    return df.select(
        *scope, "id", "group_id", "kind", o.alias("out_degree"), i.alias("in_degree"), r.alias("out_relationships"),
        ((o > 0) & (i == 0)).alias("is_source"),
        ((i > 0) & (o == 0)).alias("is_destination"),
        ((i > 0) & (o > 0)).alias("is_transform"),
        (r > 1).alias("is_router"),
        ((i == 0) & (o == 0)).alias("is_unconnected"))


def error_paths(connections: DataFrame, relationships: DataFrame, queue: DataFrame,
                scope: Sequence[str] = ()) -> DataFrame:
    """Connections that carry ``failure``, with their queued load."""
    key = [*scope, "connection_id"]
    fail = relationships.where(F.col("relationship") == FAILURE).select(*key).distinct()
    load = queue.groupBy(*key).agg(
        F.count(F.lit(1)).alias("queued_items"), F.sum("size_bytes").cast("bigint").alias("queued_bytes"))
    return connections.select(*scope, F.col("id").alias("connection_id"), "group_id", "source_id",
                              "destination_id") \
        .join(fail, key) \
        .join(load, key, "left") \
        .select(*key, "group_id", "source_id", "destination_id",
                F.coalesce("queued_items", F.lit(0)).cast("bigint").alias("queued_items"),
                F.coalesce("queued_bytes", F.lit(0)).cast("bigint").alias("queued_bytes"))


def unrouted_failures(processors: DataFrame, connections: DataFrame,
                      relationships: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Processors whose failures go nowhere.

    A processor qualifies when no outgoing connection carries ``failure`` and
    ``failure`` is not auto-terminated on it (``auto_terminated`` column, when
    the table has one).
    """
    routed = relationships.where(F.col("relationship") == FAILURE) \
        .join(connections.select(*scope, F.col("id").alias("connection_id"), "source_id"), [*scope, "connection_id"]) \
        .select(*scope, F.col("source_id").alias("id")).distinct()
    df = processors.join(routed, [*scope, "id"], "left_anti")
    if "auto_terminated" in processors.columns:
        df = df.where(~F.coalesce(F.array_contains("auto_terminated", FAILURE), F.lit(False)))
    return df.select(*scope, "id", "group_id", "name", "type")
