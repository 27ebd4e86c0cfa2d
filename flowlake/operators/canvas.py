"""Flow documents → flat tables (A2), per-document counts (D5), root id (B1).

Exploding is narrow: each document row becomes its member rows in the same
task, no shuffle.  ``explode`` (not ``explode_outer``): a missing list gives no
rows.  A document may come in parts (``sources.flowdocs``): members are read
from all its lines, the group's own fields from the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import DEFAULT_ROOT_NAME

GROUP_ID = "processGroupFlow.id"


def list_size(c: Column) -> Column:
    """Entries in a list column; a missing list counts 0."""
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c)).cast("bigint")


def in_parts(docs: DataFrame) -> Column:
    """Whether a line is one part of its document (false: the whole)."""
    return F.col("part").isNotNull() if "part" in docs.columns else F.lit(False)


def whole_only(docs: DataFrame) -> DataFrame:
    """The documents of a stream, where a part is an error: a micro-batch may hold some parts of a document only."""
    return docs.where(F.when(in_parts(docs), F.raise_error(F.lit("documents in parts need a batch"))
                             .cast("boolean")).otherwise(F.lit(True)))


def _first_lines(docs: DataFrame) -> DataFrame:
    """One line per document."""
    return docs.where(~in_parts(docs) | (F.col("part.number") == 0)) if "part" in docs.columns else docs


def _members(docs: DataFrame, kind: str) -> DataFrame:
    return docs.select(F.col(GROUP_ID).alias("group_id"), F.explode(f"processGroupFlow.flow.{kind}").alias("m"))


def canvas_explode(docs: DataFrame) -> dict[str, DataFrame]:
    """A2: the seven member tables of flow documents, flattened.

    Validation errors are read from ``status`` and, when absent there, from
    ``component``.
    """
    m = F.col("m")
    out = {}
    out["processors"] = _members(docs, "processors").select(
        m.id.alias("id"), "group_id", m.component.getField("name").alias("name"),
        m.component.type.alias("type"), m.status.runStatus.alias("run_status"),
        m.revision.version.alias("version"),
        F.coalesce(m.status.validationErrors, m.component.validationErrors).alias("validation_errors"),
        m.component.config.properties.alias("properties"),
        m.component.config.autoTerminatedRelationships.alias("auto_terminated"),
        m.component.position.x.alias("x"), m.component.position.y.alias("y"))
    out["connections"] = _members(docs, "connections").select(
        m.id.alias("id"), "group_id", m.component.getField("name").alias("name"),
        m.component.source.id.alias("source_id"), m.component.source.groupId.alias("source_group_id"),
        m.component.source.type.alias("source_type"),
        m.component.destination.id.alias("destination_id"),
        m.component.destination.groupId.alias("destination_group_id"),
        m.component.destination.type.alias("destination_type"),
        m.component.selectedRelationships.alias("relationships"),
        m.component.backPressureObjectThreshold.alias("bp_objects"),
        m.component.backPressureDataSizeThreshold.alias("bp_size"),
        m.component.flowFileExpiration.alias("expiration"))
    out["processGroups"] = _members(docs, "processGroups").select(
        m.id.alias("id"), F.col("group_id").alias("parent_id"), m.component.getField("name").alias("name"))
    for kind, label in (("inputPorts", "INPUT_PORT"), ("outputPorts", "OUTPUT_PORT")):
        out[kind] = _members(docs, kind).select(
            m.id.alias("id"), "group_id", F.lit(label).alias("kind"),
            m.component.getField("name").alias("name"), m.component.state.alias("run_status"))
    for kind in ("funnels", "labels"):
        out[kind] = _members(docs, kind).select(m.id.alias("id"), "group_id")
    return out


def flow_counts(docs: DataFrame) -> DataFrame:
    """Number of entries per member kind in each document (missing list = 0).

    Narrow for whole documents; the parts of a document are counted one by one
    and summed, which needs a batch.
    """
    names = {"processors": "n_processors", "connections": "n_connections",
             "processGroups": "n_process_groups", "inputPorts": "n_input_ports",
             "outputPorts": "n_output_ports", "funnels": "n_funnels", "labels": "n_labels"}
    sizes = [list_size(F.col(f"processGroupFlow.flow.{k}")).alias(names[k]) for k in S.FLOW_KINDS]
    if "part" not in docs.columns:
        return docs.select(F.col(GROUP_ID).alias("group_id"), *sizes)
    if docs.isStreaming:
        return whole_only(docs).select(F.col(GROUP_ID).alias("group_id"), *sizes)
    whole = docs.where(~in_parts(docs)).select(F.col(GROUP_ID).alias("group_id"), *sizes)
    parts = docs.where(in_parts(docs)).select(F.col("part.document").alias("document"), F.col(GROUP_ID).alias("group_id"), *sizes)
    return whole.unionByName(parts.groupBy("document").agg(
        F.max("group_id").alias("group_id"), *[F.sum(n).alias(n) for n in names.values()]).drop("document"))


def document_groups(docs: DataFrame) -> DataFrame:
    """Group rows of the documents: id, parent id, breadcrumb name."""
    return _first_lines(docs).select(
        F.col(GROUP_ID).alias("id"), F.col("processGroupFlow.parentGroupId").alias("parent_id"),
        F.col("processGroupFlow.breadcrumb.breadcrumb.name").alias("name"))


def root_from_documents(docs: DataFrame, default_name: str = DEFAULT_ROOT_NAME) -> DataFrame:
    """B1 on documents: the top-level ``id``, else ``processGroupFlow.id``; error when both are empty.

    Applied to the documents without a parent (the root's document).
    """
    top = F.nullif(F.col("id"), F.lit(""))
    inner = F.nullif(F.col("processGroupFlow.id"), F.lit(""))
    rid = F.coalesce(top, inner)
    roots = _first_lines(docs).where(F.col("processGroupFlow.parentGroupId").isNull())
    return roots.select(
        F.when(rid.isNull(), F.raise_error(F.lit("root process group id not found"))).otherwise(rid)
        .alias("root_id"),
        F.coalesce(F.col("processGroupFlow.breadcrumb.breadcrumb.name"), F.lit(default_name)).alias("name"),
        F.col("processGroupFlow.uri").alias("uri"),
        F.col("processGroupFlow.parentGroupId").alias("parent_group_id"),
        F.col("processGroupFlow.parameterContext.id").alias("parameter_context_id"))


def pipeline_list_from_documents(docs: DataFrame, root_name: str = "root",
                                 child_prefix: str = "ProcessGroup-") -> DataFrame:
    """E1 on documents: the root document's group and its ``processGroups`` list.

    The root's name comes from its breadcrumb (default ``root``), its parent is
    ``root``; a child without a name is ``ProcessGroup-<id>``.  Narrow: one
    explode of the child lists in the root document's lines.
    """
    def root(lines):
        return lines.where(F.col("processGroupFlow.parentGroupId").isNull()).select(
            F.coalesce(F.col(GROUP_ID), F.lit("root")).alias("id"),
            F.coalesce(F.col("processGroupFlow.breadcrumb.breadcrumb.name"), F.lit(root_name)).alias("root_name"),
            F.col("processGroupFlow.flow.processGroups").alias("kids"))

    top = root(_first_lines(docs)).select("id", F.col("root_name").alias("name"), F.lit(root_name).alias("parent"))
    kids = root(docs).select("root_name", F.explode("kids").alias("k")).select(
        F.col("k.id").alias("id"),
        F.coalesce(F.col("k.component").getField("name"), F.concat(F.lit(child_prefix), F.col("k.id"))).alias("name"),
        F.col("root_name").alias("parent"))
    return top.unionByName(kids)
