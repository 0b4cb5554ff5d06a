"""Connected components of a graph that only ever exists as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habispark.llm.tables import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns node, component (smallest node reachable) for every node of `edges` (long a, b).

    Large-star and small-star alternate until nothing changes: every node first points its larger
    neighbours, then its smaller ones, at the smallest node around it. Each round is two aggregations
    with partial sums and two joins whose skewed side adaptive execution can split, so a node with
    a large share of all edges is no obstacle. Rounds are stored, not cached.
    """
    edges = stored(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        # Large-star, over both directions of each edge.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("nearest"))
        large = (
            both.join(nearest, "a")
            .filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("a", "nearest").alias("b"))
            .distinct()
        )
        # Small-star: every a is larger than its b here.
        nearest = large.groupBy("a").agg(F.min("b").alias("nearest"))
        small = (
            large.join(nearest, "a")
            .select(
                F.explode(
                    F.array(
                        F.struct(F.col("a"), F.col("nearest").alias("b")),
                        F.struct(F.col("b").alias("a"), F.col("nearest").alias("b")),
                    )
                ).alias("edge")
            )
            .select("edge.*")
            .filter(F.col("a") != F.col("b"))
            .distinct()
        )
        edges = stored(small, "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
