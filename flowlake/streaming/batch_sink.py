"""A sink by micro-batch ids, and the form of A3 and A5 that writes to it.

Each micro-batch is written to a directory of its own, named by the streaming
query's id (kept in its checkpoint) and the batch id, and counts from the
moment its row stands in the sink's manifest. A batch that Spark replays after a
crash replaces its directory if the manifest does not name it, and is skipped
if it does; readers see only what the manifest names. A query that is started
anew with an empty checkpoint has another id, so its batches are new ones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.facts import DATE_COL

QUERY, BATCH = "sink_query", "sink_batch"
NAMES = [T.StructField(QUERY, T.StringType()), T.StructField(BATCH, T.LongType())]
MANIFEST_SCHEMA = T.StructType([
    T.StructField("n_rows", T.LongType()), T.StructField("n_late", T.LongType()),
    T.StructField("newest", T.TimestampType()), *NAMES])


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row for each finished micro-batch of the sink at ``path``."""
    if not _exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/manifest")


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the finished micro-batches of the sink at ``path``, in columns ``schema``."""
    if not _exists(spark, f"{path}/rows"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType(schema.fields + NAMES)).parquet(f"{path}/rows")
    return rows.join(manifest(spark, path).select(QUERY, BATCH), [QUERY, BATCH], "left_semi").select(*schema.names)


def _write_batch(batch: DataFrame, query: str, batch_id: int, path: str, partition_by: Sequence[str],
                 prepare: Callable[[DataFrame], DataFrame], late: Column, newest: Column) -> bool:
    """Writes one micro-batch and names it in the manifest; False if that was done before."""
    spark = batch.sparkSession
    done = manifest(spark, path).where((F.col(QUERY) == query) & (F.col(BATCH) == batch_id))
    if not done.isEmpty():
        return False
    own = f"{QUERY}={query}/{BATCH}={batch_id}"
    rows = prepare(batch)
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/rows/{own}")
    finished = spark.read.schema(rows.schema).parquet(f"{path}/rows/{own}")
    _commit(finished.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(late).alias("n_late"),
                         F.max(newest).cast("timestamp").alias("newest")), f"{path}/manifest/{own}")
    return True


def _commit(entry: DataFrame, path: str) -> None:
    entry.coalesce(1).write.mode("overwrite").parquet(path)


def _start(stream: DataFrame, checkpoint: str, write, available_now: bool):
    def each(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), batch_id)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def _check_names(schema: T.StructType, *more: str) -> None:
    taken = {QUERY, BATCH, *more} & {c.lower() for c in schema.names}
    if taken:
        raise ValueError(f"columns named {sorted(taken)} clash with the sink's own")


def write_batches(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
                  available_now: bool = True):
    """A5 on a stream, by batch ids: every micro-batch once, one directory per value of ``partition_by`` in it.

    Returns the started query; ``read_batches`` reads the sink. Unlike the file
    sink, several queries can write to one ``path``. Empty micro-batches have a
    manifest row and no files. A null value of ``partition_by`` comes back as null.
    """
    _check_names(stream.schema)

    def write(batch: DataFrame, query: str, batch_id: int) -> None:
        _write_batch(batch, query, batch_id, path, partition_by, lambda rows: rows,
                     F.lit(False), F.lit(None).cast("timestamp"))

    return _start(stream, checkpoint, write, available_now)


def settle_events(stream: DataFrame, path: str, checkpoint: str, delay: str = "1 hour",
                  key: str = "event_id", time: str = "event_time", available_now: bool = True):
    """A3 with late events kept: each event once, however late it comes.

    No state store and no watermark that drops rows: what has come before is
    looked up in the sink, which is partitioned by event date. A micro-batch is
    reduced to one row an id, and joined (anti) with the ids of the sink's
    partitions of its own dates only, so events on time read the last days and
    only late ones read older days. Copies of an event must carry the same
    time; rows with a null id count as one event a day, those with a null time
    as one day.

    The driver holds the dates of a micro-batch (one for each day it has events of).
    Manifest: ``n_rows`` new events, ``n_late`` of them more than ``delay``
    behind the newest event of the micro-batches before, ``newest`` event time.
    """
    _check_names(stream.schema, DATE_COL)
    schema = T.StructType([*stream.schema.fields, T.StructField(DATE_COL, T.DateType())])

    def write(batch: DataFrame, query: str, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = manifest(spark, path).agg(F.max("newest").alias("newest")).first().newest
        border = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")

        def new(rows: DataFrame) -> DataFrame:
            rows = rows.withColumn(DATE_COL, F.to_date(time))
            dates = [r[0] for r in rows.select(DATE_COL).distinct().collect()]
            among = F.col(DATE_COL).isin([d for d in dates if d is not None])
            if None in dates:
                among = among | F.col(DATE_COL).isNull()
            old = read_batches(spark, path, schema).where(among).select(
                F.col(key).alias("_key"), F.col(DATE_COL).alias("_date"))
            found = rows.dropDuplicates([key, DATE_COL]).join(
                old, F.col(key).eqNullSafe(F.col("_key")) & F.col(DATE_COL).eqNullSafe(F.col("_date")), "left_anti")
            # few files a date; AQE splits a date with many rows over several tasks
            return found.hint("rebalance", DATE_COL)

        _write_batch(batch, query, batch_id, path, [DATE_COL], new,
                     F.coalesce(F.col(time).cast("timestamp") < border, F.lit(False)), F.col(time))

    return _start(stream, checkpoint, write, available_now)


def settled_events(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The events that ``settle_events`` wrote to ``path``, in columns ``schema`` (those of its stream)."""
    return read_batches(spark, path, T.StructType([*schema.fields, T.StructField(DATE_COL, T.DateType())])).drop(DATE_COL)
