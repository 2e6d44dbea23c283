"""Connected components of links, as alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairweather.session import Scratch


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (or the smaller) neighbours of every node on the least of them.

    The least neighbour is pre-aggregated, and the join has one row per node on
    its side, so that adaptive execution can split a node with many links.
    """
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = links.unionByName(turned) if large else turned
    least = around.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    if large:
        moved = around.where(F.col("b") > F.col("a")).join(least, "a").select("least", "b")
    else:
        moved = around.join(least, "a").select("least", "b").unionByName(
            least.select("least", F.col("a").alias("b"))
        )
    return moved.where(F.col("least") != F.col("b")).select(
        F.col("least").alias("a"), F.col("b").alias("b")
    ).distinct()


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``; the component is its least node.

    Links may repeat, point either way or from a node to itself. Every round
    halves the distances, about; rounds go to the scratch folder, and end when
    the links, stars by then, no longer change.
    """
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    low, high = F.least("a", "b"), F.greatest("a", "b")
    links = links.where(F.col("a") != F.col("b")).select(low.alias("a"), high.alias("b")).distinct()

    def state(table: DataFrame) -> tuple:
        return tuple(table.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())

    current = scratch.materialize(links, "links")
    before = state(current)
    while before[0]:
        following = scratch.materialize(_star(_star(current, True), False), "links")
        after = state(following)
        scratch.remove(current)
        current = following
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
