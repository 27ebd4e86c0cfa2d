"""Routing rows by named relationships (I1) and the routed sink (A5)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNMATCHED = "unmatched"


def relationship_route(df: DataFrame, rules: dict[str, Column],
                       auto_terminated: Iterable[str] = (), name: str = "relationship") -> DataFrame:
    """One output row per (input row, relationship it matches).

    A row matching several relationships goes to each; a null predicate is no
    match; a row matching none goes to ``unmatched``.  Rows sent to an
    auto-terminated relationship are dropped for that relationship only.
    Everything is one ``explode`` over a built-in array: no shuffle.
    """
    hits = F.array_compact(F.array(*[F.when(F.coalesce(p, F.lit(False)), F.lit(r)) for r, p in rules.items()]))
    rels = F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit(UNMATCHED)))
    out = df.select("*", F.explode(rels).alias(name))
    dropped = list(auto_terminated)
    if dropped:
        out = out.where(~F.col(name).isin(dropped))
    return out


def write_by_relationship(routed: DataFrame, path: str, name: str = "relationship",
                          mode: str = "append", fmt: str = "parquet") -> None:
    """A5: sink routed rows with one directory per relationship (``partitionBy``)."""
    routed.write.mode(mode).partitionBy(name).format(fmt).save(path)


def write_stream_by_relationship(routed_stream: DataFrame, path: str, checkpoint: str,
                                 name: str = "relationship", available_now: bool = True):
    """A5 on a stream: append routed rows under one directory per relationship.

    The checkpoint makes the file sink exactly-once across restarts.  Returns
    the started query (``availableNow`` drains what is there and stops).
    """
    w = (routed_stream.writeStream.format("parquet").partitionBy(name)
         .option("path", path).option("checkpointLocation", checkpoint).outputMode("append"))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
