"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id in ``links(a, b)``; the component is its smallest id.

    Alternates large-star and small-star: each node hands its larger, then its smaller neighbours to its smallest one, so
    every path shortens until each component is a star.  Rounds grow with the logarithm of a component's diameter; each
    is two aggregations that combine before the shuffle and two joins.  The aggregated side of a join is stored first:
    adaptive execution cannot split a join straight on an aggregation, and a hub's links would meet in one task.
    """
    edges = stage(
        links.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct(), "edges"
    )
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = stage(both.groupBy("v").agg(F.min("m").alias("low")).select("v", F.least("v", "low").alias("low")), "least")
        large = both.filter("m > v").join(least, "v").select(F.col("m").alias("v"), F.col("low").alias("m")).distinct()
        large = stage(large, "large")
        least = stage(large.groupBy("v").agg(F.min("m").alias("low")), "least")
        small = large.join(least, "v").select(F.when(F.col("m") == F.col("low"), F.col("v")).otherwise(F.col("m")).alias("v"),
                                              F.col("low").alias("m"))
        edges = stage(small.distinct(), "edges")
        seen = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "m"))).first()
        if seen == mark:
            break
        mark = seen
    roots = edges.select(F.col("m").alias("id"), F.col("m").alias("component")).distinct()
    return edges.select(F.col("v").alias("id"), F.col("m").alias("component")).unionByName(roots)
