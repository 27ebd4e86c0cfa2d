"""Registry of named queries and their independent SQL oracles.

A query is a callable ``(spark, sf_dir) -> DataFrame``.  Its oracle is plain SQL
over the driver's base tables: the fixture views it needs are put in a ``WITH``
list ahead of the query text, so DuckDB runs it without any of our code.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.fixtures import with_clause

QueryFn = Callable[[SparkSession, str], DataFrame]


def nullable_as_double(df: DataFrame, *cols: str) -> DataFrame:
    """Return integer columns that can hold nulls as DOUBLE.

    Spark and DuckDB hand a nullable integer column to pandas differently
    (float64 with NaN vs. nullable Int64); as DOUBLE both engines give the
    same values and types.  Used only by registered queries; operators keep
    their integer types.
    """
    from pyspark.sql import functions as F
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
DOCS: dict[str, str] = {}


def two_snapshots(sql: str, recursive: bool = False, **second: str) -> str:
    """Oracle text of two snapshots: ``sql`` as it is, and over the views that ``second`` puts in their place."""
    views = "".join(f", {v.replace('fx_', 'fx2_')} AS ({text})" for v, text in second.items())
    names = re.compile(r"\b(" + "|".join(second) + r")\b")

    def body(text):
        text = text.strip()
        return f"WITH {'RECURSIVE ' if recursive else ''}{text[1:]}" if text.startswith(",") else text

    again = names.sub(lambda m: m.group().replace("fx_", "fx2_"), sql)
    return f"""{views}
SELECT 1 AS snapshot_id, a.* FROM ({body(sql)}) a
UNION ALL SELECT 2, b.* FROM ({body(again)}) b"""


def query(name: str, views=(), sql: str | None = None, recursive: bool = False):
    """Register ``fn`` under ``name``; ``sql`` (if any) is its oracle.

    ``sql`` may start with ``,`` to add its own CTEs after the fixture views;
    ``recursive`` turns the ``WITH`` list into ``WITH RECURSIVE``.
    """

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name!r}")
        QUERIES[name] = fn
        DOCS[name] = (fn.__doc__ or "").strip()
        if sql is not None:
            text = with_clause(views) + sql.strip()
            if recursive:
                text = "WITH RECURSIVE " + text[len("WITH "):]
            ORACLE[name] = text
        return fn

    return deco
