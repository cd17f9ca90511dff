"""Connected components of an edge table by alternating large and small stars.

Each round every node hooks its larger neighbours to its smallest neighbour
(large star), then its smaller ones (small star); the edge table ends as one
star per component after a logarithmic number of rounds. All steps are
aggregations and joins; a hub with many neighbours is one row on the small
side of a join whose other side adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.scratch import table


def _stars(e: DataFrame) -> bool:
    """Whether every larger end has one smaller end, which is no larger end itself: then the edges are the components."""
    ends = e.select(F.col("hi").alias("u"), F.lit(1).alias("h"), F.lit(0).alias("l")).unionByName(
        e.select(F.col("lo").alias("u"), F.lit(0).alias("h"), F.lit(1).alias("l"))
    )
    return ends.groupBy("u").agg(F.sum("h").alias("h"), F.max("l").alias("l")).where("h > 1 OR (h > 0 AND l > 0)").isEmpty()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has an edge; root: its component's smallest node.

    Null ends and loops are ignored, repeated edges count once; no edge gives no row.
    """
    e = (
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct()
    )
    e = table(e, "edges")
    while not _stars(e):
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        # written, so that the join below has two exchanges and a hub's side can be split
        least = table(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
        large = both.join(least, "u").where(F.col("v") > F.col("u"))
        large = large.select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = table(small.unionByName(low.withColumnRenamed("m", "lo")).distinct(), "edges")
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )
