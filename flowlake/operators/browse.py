"""Projections, filters and lookups over the flat estate tables.

Arguments that name a handful of ids (group ids, requested entity ids) are
turned into a small DataFrame whose size is the length of the argument list,
so broadcasting it is bounded by construction.  Fact tables are never
broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import position_within
from ..functions.text import DEFAULT_ROOT_NAME


def _ids_frame(spark: SparkSession, ids: Iterable, name: str = "requested_id",
               id_type: str = "string") -> DataFrame:
    ids = list(dict.fromkeys(ids))
    return spark.createDataFrame([(i,) for i in ids], f"{name} {id_type}")


def root_group(groups: DataFrame, default_name: str = DEFAULT_ROOT_NAME) -> DataFrame:
    """B1 on a group table: the group without a parent, name defaulted; an error if there is none."""
    is_root = F.col("parent_id").isNull()
    roots = groups.where(is_root).select(
        F.col("id").alias("root_id"),
        F.coalesce(F.col("name"), F.lit(default_name)).alias("name"),
        F.col("parent_id").alias("parent_group_id"),
    )
    none = groups.agg(F.count_if(is_root).alias("n")).where("n = 0").select(
        F.raise_error(F.lit("root process group id not found")).cast("string").alias("root_id"),
        F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("parent_group_id"))
    return roots.unionByName(none)


def group_processors(processors: DataFrame, group_ids: Iterable[str]) -> DataFrame:
    """B2: processors of the given groups (a pushed-down ``IN`` filter)."""
    return processors.where(F.col("group_id").isin(list(group_ids)))


def group_connections(connections: DataFrame, group_ids: Iterable[str]) -> DataFrame:
    """Connections owned by the given groups."""
    return connections.where(F.col("group_id").isin(list(group_ids)))


def group_children(groups: DataFrame, parent_ids: Iterable[str]) -> DataFrame:
    """Immediate children only."""
    return groups.where(F.col("parent_id").isin(list(parent_ids)))


def group_ports(ports: DataFrame, group_ids: Iterable[str],
                output_ports: DataFrame | None = None) -> DataFrame:
    """Input and output ports of the groups; ``kind`` tells them apart.

    When input and output ports arrive as two tables they are stacked with
    ``unionByName`` first.
    """
    both = ports if output_ports is None else ports.unionByName(output_ports)
    return both.where(F.col("group_id").isin(list(group_ids)))


def entity_lookup(spark: SparkSession, table: DataFrame, ids: Iterable,
                  key: str = "id", id_type: str = "string") -> DataFrame:
    """Details by id; an unknown id is reported with ``found = false``.

    The ids become an ``IN`` filter that reaches the Parquet scan, so only the
    matching rows leave it; the requested ids are then the preserved side of a
    left join with those few rows (an outer join cannot broadcast its preserved
    side, so the table itself is never what gets joined).
    """
    ids = list(dict.fromkeys(ids))
    req = _ids_frame(spark, ids, id_type=id_type)
    hits = table.where(F.col(key).isin(ids)).withColumn("_found", F.lit(True))
    out = req.join(hits, F.col("requested_id") == F.col(key), "left")
    return out.select("requested_id", F.coalesce("_found", F.lit(False)).alias("found"), *table.columns)


def processor_type_catalog(types: DataFrame) -> DataFrame:
    """Type, bundle, description (default ''), tags (default ''), deduplicated."""
    return types.select(
        "type", "bundle",
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce("tags", F.lit("")).alias("tags"),
    ).distinct()


def _contains(c: str, q: str):
    # instr on lower-cased text: '%', '_' and '.' in q stay literal.
    return F.coalesce(F.instr(F.lower(F.col(c)), F.lit(q.lower())) > 0, F.lit(False))


def component_search(q: str, **kinds: DataFrame) -> DataFrame:
    """One query string over every component kind.

    ``kinds`` maps a kind name to a table with ``id`` and optionally ``name``
    and ``type``.  Matching is a case-insensitive literal substring test; the
    result has one row per matching component with the fields that matched.
    """
    parts = []
    for kind, df in kinds.items():
        fields = [c for c in ("id", "name", "type") if c in df.columns]
        hits = [F.when(_contains(c, q), F.lit(c)) for c in fields]
        any_hit = None
        for c in fields:
            any_hit = _contains(c, q) if any_hit is None else (any_hit | _contains(c, q))
        name = F.col("name") if "name" in df.columns else F.lit(None).cast("string")
        parts.append(df.where(any_hit).select(
            F.lit(kind).alias("kind"), "id", name.alias("name"),
            F.concat_ws(",", *hits).alias("matched_on")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def bulletin_feed(bulletins: DataFrame, group_id: str | None = None,
                  source_id: str | None = None, limit: int = 100) -> DataFrame:
    """Bulletins, optional group/source filters (empty = no filter), newest first.

    ``orderBy(...).limit(n)`` plans as a top-k (``TakeOrderedAndProject``), so
    each task keeps only ``n`` rows; ``id`` breaks ties on ``ts``.
    """
    df = bulletins
    if group_id:
        df = df.where(F.col("group_id") == group_id)
    if source_id:
        df = df.where(F.col("source_id") == source_id)
    return df.orderBy(F.col("ts").desc(), F.col("id").desc()).limit(int(limit))


def queue_listing(queue: DataFrame, connection_ids: Iterable[str] | None = None,
                  order=("queued_at", "flowfile_uuid", "size_bytes")) -> DataFrame:
    """Items queued on connections with their 1-based queue position.

    The position is computed by a range-partitioned sort, so one very long
    queue is spread over many tasks instead of one window partition.
    """
    df = queue
    if connection_ids is not None:
        df = df.where(F.col("connection_id").isin(list(connection_ids)))
    return position_within(df, ["connection_id"], list(order), "position")
