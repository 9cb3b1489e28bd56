"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobmeld.functions.binding import detached
from jobmeld.llm.common import stored


def _lowest(links: DataFrame) -> DataFrame:
    """(a, low): the least of each node and its neighbours."""
    return links.groupBy("a").agg(F.min("b").alias("low")).select(
        detached(F.col("a")).alias("node"), F.least("a", "low").alias("low")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in `edges` (a, b), root being the least node of its component.

    Alternates two steps until nothing changes: every node hangs its larger neighbours on the least node it
    knows, then hangs itself and its smaller neighbours there. Both keep the components as they are and need
    a number of rounds logarithmic in their size; a round is written to the shared folder. Equal nodes, empty
    input and repeated edges are allowed; a null end drops the edge.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    now, before = stored(now, "edges"), None
    while True:
        sign = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == before or not sign[0]:
            break
        before = sign
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_lowest(both), F.col("a") == F.col("node")).filter("b > a")
        large = large.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        small = large.join(_lowest(large), F.col("a") == F.col("node"))
        small = small.select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        now = stored(small.filter("a <> b").distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
