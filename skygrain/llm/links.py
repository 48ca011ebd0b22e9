"""Connected components over edge tables, by joins and pre-combined minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skygrain.plans.durable import materialize, shuffled


def components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """``node, component`` (the least node reachable) for every node of an edge table without self-links.

    Each round passes the least label to neighbours and to the neighbours' old labels, then follows labels twice, so
    that chains halve. Every round is written to the shared folder. All reductions are minima, which Spark combines
    before each shuffle; the joins leave a hot node's rows to Spark's skew splitting. No table is broadcast: they grow with
    the edges.
    """
    both = materialize(
        edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
        .unionByName(edges.select(F.col(dst).alias("a"), F.col(src).alias("b")))
        .distinct(),
        "edges",
    )
    labels = both.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("node"), F.least("a", "least").alias("component")
    )
    labels = materialize(labels, "labels")
    while True:
        heard = both.join(shuffled(labels), both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("heard"))
        told = labels.join(shuffled(heard), labels["node"] == heard["a"]).select(
            "node", "component", F.least("component", "heard").alias("new")
        )
        offers = told.select("node", "new").unionByName(told.select(F.col("component").alias("node"), "new"))
        hooked = offers.groupBy("node").agg(F.min("new").alias("up"))
        above = hooked.select(F.col("node").alias("up"), F.col("up").alias("upper"))
        jumped = hooked.join(shuffled(above), "up").select("node", F.least("up", "upper").alias("component"))
        after = materialize(
            jumped.join(shuffled(labels.select("node", F.col("component").alias("old"))), "node"), "labels"
        )
        moved = after.filter("component <> old").limit(1).count()
        labels = after.select("node", "component")
        if not moved:
            return labels
