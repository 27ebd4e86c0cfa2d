"""Flow documents: read them (A1) and, for tests, build them from flat tables.

A flow document is one group's canvas: the group's own fields plus seven
member lists.  Documents are read as JSON lines with the explicit schema in
``flowlake.schemas`` (``PERMISSIVE``; a malformed line lands in
``_corrupt_record``), batch or streaming with the same schema.

A group can have more members than one JSON line or one row can hold, so a
document may come in parts: lines with the group's own fields and ``part``
(``document``, the same for all its lines; ``number``, 0 for exactly one of
them), each with some of the members.  A line without ``part`` is a whole
document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import rounds, shuffles_dropped

#: Entries in one line of a document in parts, at most.
PART_ENTRIES = 500
#: A group's members are dealt to this many tasks by the hash of the row.
DEALT = 16
#: Documents in one file, at most: compressed files are read by one task each.
FILE_DOCS = 2000


def read_flow_docs(spark: SparkSession, path: str, multi_line: bool = False,
                   streaming: bool = False) -> DataFrame:
    """A1: one row per flow document, or per part of one; missing keys read as null.

    ``multi_line`` is for pretty-printed single-document files (not
    splittable); JSON lines is the scalable layout.
    """
    reader = spark.readStream if streaming else spark.read
    return (reader.schema(S.FLOW_DOCUMENT)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("multiLine", str(bool(multi_line)).lower())
            .json(path))


def build_flow_docs(groups: DataFrame, processors: DataFrame, connections: DataFrame,
                    ports: DataFrame, funnels: DataFrame | None = None, labels: DataFrame | None = None) -> DataFrame:
    """Nest flat tables into flow documents in parts (test input only).

    Each group row is a document: a first line with the group's own fields, and
    lines of at most ``PART_ENTRIES`` members.  A group without members has null
    lists.  No list is longer than a line, and no group is gathered into one
    task.  This builds stand-in input; no operator depends on it.
    """
    return _first_docs(groups).unionByName(_part_docs(groups, _members(groups, processors, connections, ports, funnels, labels)))


def write_estate_docs(path: str, groups: DataFrame, processors: DataFrame, connections: DataFrame,
                      ports: DataFrame, funnels: DataFrame | None = None, labels: DataFrame | None = None) -> None:
    """Write the rows of ``build_flow_docs``, the lines of many members in rounds: disk holds the shuffle of one at a time."""
    members = _members(groups, processors, connections, ports, funnels, labels)
    n = min(rounds(members.select("group_id").count()), DEALT)
    for i in range(n):
        lines = _part_docs(groups, members, range(i, DEALT, n))
        write_flow_docs(lines if i else _first_docs(groups).unionByName(lines), path, "append" if i else "overwrite")


def _members(groups: DataFrame, processors: DataFrame, connections: DataFrame,
             ports: DataFrame, funnels: DataFrame | None, labels: DataFrame | None) -> DataFrame:
    """(group_id, dealt, one column a kind with the entry) of every member with a group."""
    null = F.lit(None).cast
    tables = {
        "processors": (processors, "group_id", F.struct(
            F.col("id"),
            F.struct(null("string").alias("clientId"), F.col("version").cast("bigint").alias("version")).alias("revision"),
            F.struct(F.col("name"), F.col("type"), null(S.POSITION).alias("position"),
                     null(S.PROCESSOR["component"].dataType["config"].dataType).alias("config"),
                     null("array<string>").alias("validationErrors")).alias("component"),
            F.struct(F.col("run_status").alias("runStatus"),
                     F.col("validation_errors").alias("validationErrors")).alias("status"))),
        "connections": (connections, "group_id", F.struct(
            F.col("id"),
            null(S.REVISION).alias("revision"),
            F.struct(
                null("string").alias("name"),
                F.struct(F.col("source_id").alias("id"), F.col("group_id").alias("groupId"),
                         F.lit("PROCESSOR").alias("type")).alias("source"),
                F.struct(F.col("destination_id").alias("id"), F.col("group_id").alias("groupId"),
                         F.lit("PROCESSOR").alias("type")).alias("destination"),
                null("array<string>").alias("selectedRelationships"),
                F.col("bp_objects").cast("bigint").alias("backPressureObjectThreshold"),
                F.col("bp_size").alias("backPressureDataSizeThreshold"),
                F.col("expiration").alias("flowFileExpiration")).alias("component"))),
        "processGroups": (groups, "parent_id", F.struct(F.col("id"), F.struct(F.col("name")).alias("component"))),
    }
    for kind, label in (("inputPorts", "INPUT_PORT"), ("outputPorts", "OUTPUT_PORT")):
        tables[kind] = (ports.where(F.col("kind") == label), "group_id", F.struct(
            F.col("id"), null(S.REVISION).alias("revision"),
            F.struct(F.col("name"), F.col("run_status").alias("state")).alias("component")))
    for table, kind in ((funnels, "funnels"), (labels, "labels")):
        if table is not None:
            tables[kind] = (table, "group_id", F.struct("id"))

    members = None
    for kind, (table, group, entry) in tables.items():
        rows = table.where(F.col(group).isNotNull()).select(
            F.col(group).alias("group_id"), entry.alias("entry"),
            F.pmod(F.xxhash64(*table.columns), F.lit(DEALT)).cast("int").alias("dealt")).select(
            "group_id", "dealt",
            *[(F.col("entry") if k == kind else null(S.FLOW[k].dataType.elementType)).alias(k) for k in S.FLOW_KINDS])
        members = rows if members is None else members.unionByName(rows)
    return members


HEAD = ["group_id", "document", "parent_id", "name"]


def _heads(groups: DataFrame) -> DataFrame:
    # group rows that share an id are documents of their own, each with all members
    copy = F.row_number().over(Window.partitionBy("id").orderBy("parent_id", "name"))
    return groups.select(F.col("id").alias("group_id"), "parent_id", "name", F.when(
        F.col("id").isNotNull(), F.concat_ws("/", "id", copy.cast("string"))).alias("document"))


def _first_docs(groups: DataFrame) -> DataFrame:
    """The first line of every document."""
    return _documents(_heads(groups).select(*HEAD, F.lit(0).cast("bigint").alias("number"),
                                            *[F.lit(None).cast(S.FLOW[k].dataType).alias(k) for k in S.FLOW_KINDS]))


def _part_docs(groups: DataFrame, members: DataFrame, numbers: range = range(DEALT)) -> DataFrame:
    """The lines of the members that were dealt these numbers."""
    dealt = _heads(groups).where(F.col("document").isNotNull()).withColumn(
        "dealt", F.explode(F.array(*[F.lit(i) for i in numbers])))
    if len(numbers) < DEALT:
        members = members.where(F.col("dealt").isin(*numbers))
    # shuffled by group and dealt number, which the steps after it keep: never one group in one task or broadcast
    at = F.row_number().over(Window.partitionBy("group_id", "dealt", "document").orderBy(F.lit(0)))
    lists = [F.collect_list(k).alias(k) for k in S.FLOW_KINDS]
    parts = (members.join(dealt.hint("merge"), ["group_id", "dealt"])
             .withColumn("cut", F.floor((at - 1) / PART_ENTRIES))
             .groupBy("dealt", *HEAD, "cut").agg(*lists)
             .select(*HEAD, (F.col("cut") * DEALT + F.col("dealt") + 1).alias("number"),
                     *[F.when(F.size(k) > 0, F.col(k)).alias(k) for k in S.FLOW_KINDS]))
    return _documents(parts)


def _documents(lines: DataFrame) -> DataFrame:
    null = F.lit(None).cast
    return lines.select(
        F.col("group_id").alias("id"),
        F.struct(
            F.col("group_id").alias("id"),
            F.concat(F.lit("/flow/process-groups/"), F.col("group_id")).alias("uri"),
            F.col("parent_id").alias("parentGroupId"),
            null(S.FLOW_DOCUMENT["processGroupFlow"].dataType["parameterContext"].dataType).alias("parameterContext"),
            F.struct(F.struct(F.col("name")).alias("breadcrumb")).alias("breadcrumb"),
            F.struct(*S.FLOW_KINDS).alias("flow"),
        ).alias("processGroupFlow"),
        F.when(F.col("document").isNotNull(), F.struct("document", "number")).alias("part"))


def write_flow_docs(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write documents as compressed JSON lines (nulls omitted, as an API would)."""
    with shuffles_dropped(docs.sparkSession):
        docs.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", FILE_DOCS).json(path)
