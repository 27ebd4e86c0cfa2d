"""Connected components of an edge table by repeated hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every endpoint of ``edges`` (a, b: long); root is one id per component.

    Each round every node hooks to its smallest neighbour if that is smaller,
    pointers are doubled twice, and the edges are contracted to the new
    roots. At least half of the nodes of a component vanish per round, so the
    rounds are logarithmic; a hub's edges meet only in pre-aggregated minima
    and many-to-one joins. Rounds are cut by tables in the shared folder.
    Self-links and repeated edges are allowed; no edges give no rows.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = written(both.distinct(), "cc-edges")
    labels = None
    while labels is None or not rest.isEmpty():
        parent = written(rest.groupBy(F.col("a").alias("node"))
                         .agg(F.min("b").alias("low"))
                         .select("node", F.least("node", "low").alias("up")), "cc-parent")
        jumped = parent
        for _ in range(2):
            step = jumped.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = jumped.join(step, "up").select("node", F.col("top").alias("up"))
        jumped = written(jumped, "cc-jump")
        if labels is None:
            labels = jumped.select("node", F.col("up").alias("root"))
        else:
            labels = written(
                labels.join(jumped.select(F.col("node").alias("root"), "up"), "root", "left")
                .select("node", F.coalesce("up", "root").alias("root")), "cc-labels")
        left = jumped.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        right = jumped.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        rest = written(rest.filter("a != b").join(left, "a").join(right, "b")
                       .filter("ra != rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "cc-edges")
    return labels
