"""Provenance search and event content.

The provenance table is the largest fact table.  Search terms become plain
equality predicates, which reach the Parquet scan as pushed filters, and the
newest-first cut is a top-k (``TakeOrderedAndProject``): each task keeps at
most ``max_results`` rows and nothing is globally sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.facts import DATE_COL

from ..functions import text as T

# Search-term names (as the remote product spells them) → columns of our table.
TERM_COLUMNS = {"ProcessorID": "component_id", "FlowFileUUID": "flowfile_uuid"}
DETAIL_COLUMNS = ["details"]
DIRECTIONS = ("input", "output")


def _term_column(key: str, columns) -> str:
    """Map a search key to a column, the way the reference maps keys to terms.

    Known keys map through ``PROVENANCE_KEY_MAP``; any other key is capitalised
    (first letter upper, rest lower) and must then name a column of the table
    (case-insensitively); otherwise it is an error.
    """
    term = T.PROVENANCE_KEY_MAP.get(key) or key.capitalize()
    if term in TERM_COLUMNS:
        return TERM_COLUMNS[term]
    for c in columns:
        if c.lower() == term.lower():
            return c
    raise ValueError(f"unknown provenance search term {key!r} (tried {term!r})")


def provenance_search(events: DataFrame, terms: dict, max_results: int = 1000,
                      summarize: bool = True, start=None, end=None) -> DataFrame:
    """events matching all terms, newest first, at most ``max_results``.

    ``terms`` maps a key to a value or to ``(value, inverse)``; an inverse term
    keeps the events that do *not* match, those without a value included.  ``summarize`` drops the detail
    columns.  ``start`` and ``end`` bound the event time, both included; an
    event without a time is in no such range.  On the fact layout they also bound
    the date, which prunes partitions.
    """
    df, time = events, events.schema["event_time"].dataType
    for bound, within in ((start, "__ge__"), (end, "__le__")):
        if bound is not None:
            at = F.lit(str(bound)).cast(time)
            df = df.where(getattr(F.col("event_time"), within)(at))
            if DATE_COL in events.columns:
                df = df.where(getattr(F.col(DATE_COL), within)(at.cast("date")))
    for key, spec in terms.items():
        value, inverse = (spec if isinstance(spec, tuple) else (spec, False))
        col = _term_column(key, events.columns)
        cond = F.col(col) == F.lit(value)
        df = df.where(~F.coalesce(cond, F.lit(False)) if inverse else cond)
    if summarize:
        df = df.drop(*[c for c in DETAIL_COLUMNS if c in df.columns])
    return df.orderBy(F.col("event_time").desc(), F.col("event_id").desc()).limit(int(max_results))


def provenance_event_content(events: DataFrame, content: DataFrame, direction: str) -> DataFrame:
    """Each event with its input or output body; a missing body is reported.

    ``content`` has one row per claim: ``claim_id``, ``body`` and any further
    columns, which come out as they are (null where the claim is missing).
    ``direction`` must be exactly ``input`` or ``output``.  Many events share a
    claim; AQE splits a hot claim's partition on the event side.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be 'input' or 'output', got {direction!r}")
    claim = F.col(f"{direction}_claim")
    ev = events.select("event_id", claim.alias("claim_id"))
    columns = [c for c in content.columns if c != "claim_id"]
    body = content.select("claim_id", *columns, F.lit(True).alias("_found"))
    return ev.join(body, "claim_id", "left").select(
        "event_id", F.lit(direction).alias("direction"), "claim_id",
        F.coalesce("_found", F.lit(False)).alias("found"), *columns)
