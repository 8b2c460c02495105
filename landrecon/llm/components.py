"""Connected components of a graph given by its links, by alternating star contraction.

Each round hangs the larger neighbours of a node on its smallest one, then does the same among the
smaller neighbours, until every link leads straight to the smallest node of its component. The
number of links never grows, a node's neighbours are reduced to their minimum before they move,
and the lookup joins let a node with very many links be split over tasks. Every round is written
to the shared folder, so lost executors re-read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from landrecon.operators.lookups import attach
from landrecon.session import stage


def _stars(links: DataFrame) -> DataFrame:
    """Hang the neighbours ``v`` of each ``u`` on the smallest of them and ``u``."""
    smallest = links.groupBy("u").agg(F.min("v").alias("m"))
    hung = attach(links, smallest.select("u", F.least("u", "m").alias("m")), ["u"], "inner")
    return hung


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with a link to another; component is the smallest node.

    Links that are NULL on a side, or lead from a node to itself, are left out.
    """
    known = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))
    )
    current = stage(known.distinct(), "links")
    seen = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _stars(both).filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        hung = _stars(large)
        small = hung.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = stage(small.unionByName(hung.select("u", F.col("m").alias("v"))).distinct(), "stars")
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = state
