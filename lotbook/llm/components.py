"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotbook.llm.common import written

_MOST_ROUNDS = 40


def _neighbours(links: DataFrame, both_ways: bool) -> DataFrame:
    """(node, other), and with ``both_ways`` each link from either end."""
    if not both_ways:
        return links
    turned = F.struct(F.col("other").alias("node"), F.col("node").alias("other"))
    return links.select(F.explode(F.array(F.struct("node", "other"), turned)).alias("e")).select(
        "e.node", "e.other"
    )


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Every node's larger (large star) or smaller (small star) neighbours, and for the small
    star the node itself, linked to the least of its neighbourhood.

    ``links`` has the larger node first. The least neighbour is a plain minimum, combined in the
    map tasks; the join back on a node with very many links is a merge join, which is split at
    run time.
    """
    near = _neighbours(links, both_ways=large)
    least = near.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    joined = near.join(least.hint("merge"), "node")
    if large:
        moved = joined.filter(F.col("other") > F.col("node")).select(
            F.col("other").alias("node"), F.col("least").alias("other")
        )
    else:
        moved = joined.select(
            F.explode(F.array("node", "other")).alias("node"), F.col("least").alias("other")
        )
    return moved.filter(F.col("node") != F.col("other")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; the component is its least node.

    ``links`` has two columns of ids that compare; direction, repeats and loops do not matter.
    Each round is written to the shared folder, so lineage stays short and a lost executor costs
    a re-read. The rounds end when nothing moves; their number grows with the logarithm of the
    longest chain. Only counts reach the driver.
    """
    a, b = (F.col(c) for c in links.columns)
    ordered = links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other"))
    ordered = ordered.filter(F.col("node") != F.col("other")).distinct()
    current = written(ordered, "links")
    before = None
    for _ in range(_MOST_ROUNDS):
        current = written(_star(_star(current, large=True), large=False), "links")
        now = current.agg(
            F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))
        ).first()
        if now == before:
            least = current.select(F.col("other").alias("node")).distinct()
            found = current.select("node", F.col("other").alias("component"))
            return found.unionByName(least.withColumn("component", F.col("node")))
        before = now
    raise RuntimeError(f"links still move after {_MOST_ROUNDS} rounds")
