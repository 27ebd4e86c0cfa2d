"""Structured Streaming forms: provenance follow (A3), bulletin follow (A4).

Both take a stream of provenance events or bulletins, as the batch operators
take tables of them, and write to a sink with a checkpoint, so a restart
resumes where it stopped and adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_path

PROGRESS = "spark.sql.streaming.numRecentProgressUpdates"
#: Micro-batches whose progress a drained query keeps, between two looks at it.
KEPT_PROGRESS = 10_000

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def read_event_stream(spark: SparkSession, source_dir: str, glob: str = "events*.parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over the event files of ``source_dir``."""
    r = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(source_dir)


def provenance_stream(provenance: DataFrame, watermark: str, event_type: str | None = None,
                      component_id: str | None = None) -> DataFrame:
    """A3: new provenance events (``event_id``, ``event_time`` and others), each id once, optional filters.

    ``dropDuplicatesWithinWatermark`` forgets an id once the watermark passes
    it, which bounds the state.  As with every Spark watermark, an event that
    comes later than ``watermark`` behind the newest event seen is dropped:
    choose at least the source's lateness.  ``drain`` tells when rows were
    dropped.  The watermark needs a zoned timestamp, so a cast copy of
    ``event_time`` drives it and the column is kept as is.
    """
    prov = provenance
    if event_type:
        prov = prov.where(F.col("event_type") == event_type)
    if component_id:
        prov = prov.where(F.col("component_id") == component_id)
    return (prov.withColumn("_wm", F.col("event_time").cast("timestamp"))
            .withWatermark("_wm", watermark)
            .dropDuplicatesWithinWatermark(["event_id"])
            .drop("_wm"))


def bulletin_stream(bulletins: DataFrame, group_id: str | None = None, source_id: str | None = None) -> DataFrame:
    """A4: bulletins as they arrive, with the same group/source filters as the batch feed (``limit`` is batch-only)."""
    df = bulletins
    if group_id:
        df = df.where(F.col("group_id") == group_id)
    if source_id:
        df = df.where(F.col("source_id") == source_id)
    return df


def _dropped(query, seen: dict[int, int]) -> None:
    """Adds to ``seen`` the rows that each micro-batch in the query's kept progress dropped as late."""
    for p in query.recentProgress:
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        seen[p.batchId] = max(seen.get(p.batchId, 0), late)


def late_rows(query) -> int:
    """Rows that a query's stateful steps dropped because they came after the watermark, until it ends.

    Spark keeps the progress of the last micro-batches only, so it is looked at
    while the query runs. Raises if a micro-batch was missed all the same.
    """
    seen: dict[int, int] = {}
    while not query.awaitTermination(0.5):
        _dropped(query, seen)
    _dropped(query, seen)
    if seen and max(seen) - min(seen) + 1 != len(seen):
        raise RuntimeError("Spark no longer had the progress of some micro-batches; late rows cannot be told")
    return sum(seen.values())


def drain(stream: DataFrame, label: str, sink_path: str | None = None,
          checkpoint: str | None = None, allow_late: bool = False) -> DataFrame:
    """Run ``stream`` to the end of the available input (``availableNow``) into a
    parquet sink under the shared folder; return the sink as a batch DataFrame.

    Raises if rows were dropped as late, unless ``allow_late``."""
    spark = stream.sparkSession
    sink_path = sink_path or shared_path(spark, f"{label}-sink")
    checkpoint = checkpoint or shared_path(spark, f"{label}-ckpt")
    kept = spark.conf.get(PROGRESS, None)
    spark.conf.set(PROGRESS, KEPT_PROGRESS)  # the query takes the session's settings when it starts
    try:
        q = (stream.writeStream.format("parquet").option("path", sink_path)
             .option("checkpointLocation", checkpoint).outputMode("append")
             .trigger(availableNow=True).start())
    finally:
        spark.conf.set(PROGRESS, kept) if kept else spark.conf.unset(PROGRESS)
    late = late_rows(q)
    if q.exception() is not None:
        raise q.exception()
    if late and not allow_late:
        raise RuntimeError(f"{late} rows came later than the watermark allows and were dropped")
    return spark.read.schema(stream.schema).parquet(sink_path)
