"""Connected components of a large graph, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asphalt.session import materialise


ROWS_PER_TASK = 50_000


def _star_shape(edges: DataFrame) -> tuple[int, int]:
    """How many edges there are, and how many nodes still have several roots or are a root themselves."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("node").alias("id"), F.lit(1).alias("up")), F.struct(F.col("root").alias("id"), F.lit(0).alias("up")))).alias("end"))
    nodes = ends.groupBy("end.id").agg(F.sum("end.up").alias("roots"), F.min("end.up").alias("least"))
    is_open = (F.col("roots") > 1) | ((F.col("roots") == 1) & (F.col("least") == 0))
    rows, still_open = nodes.agg(F.sum("roots"), F.sum(is_open.cast("long"))).first()
    return rows or 0, still_open or 0


def _scan(edges: DataFrame, rows: int) -> DataFrame:
    """A checkpoint of so many rows, read by fewer tasks than it has files if these are small."""
    return edges.coalesce(max(edges.sparkSession.sparkContext.defaultParallelism, 1 + rows // ROWS_PER_TASK))


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """The smallest reachable node of every linked node: (node, root), without the roots themselves.

    Each round hangs the neighbours of a node on its smallest neighbour, first
    the larger ones, then the others; rounds grow with the logarithm of a
    chain's length, and stars need none. Minima are partial sums. Those of the
    first step are checkpointed, so that its join is a plain equi-join and a
    node with very many neighbours is split by adaptive execution. Every round
    is checkpointed in the shared folder.
    """
    edges = materialise(
        links.where(F.col(left) != F.col(right))
        .select(F.greatest(left, right).alias("node"), F.least(left, right).alias("root")).distinct()
    )
    while True:
        rows, still_open = _star_shape(edges)
        if not still_open:
            return edges
        edges = _scan(edges, rows)
        least = _scan(materialise(edges.groupBy("node").agg(F.min("root").alias("least"))), rows)
        large = edges.join(least.withColumnRenamed("node", "root"), "root", "left").select(
            "node", F.coalesce("least", "root").alias("root"))
        large = _scan(materialise(large.distinct()), rows)
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        hung = large.join(least, "node").select(F.explode(F.array("node", "root")).alias("node"), F.col("least").alias("root"))
        edges = materialise(hung.where("node != root").distinct())
