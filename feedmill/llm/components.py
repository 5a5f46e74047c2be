"""Connected components of an edge table by alternating stars."""

from pyspark.sql import DataFrame, functions as F

from feedmill.operators.storage import materialised


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes in ``edges`` (a, b): the component is its smallest node.

    A large star links each larger neighbour of a node to the smallest one it sees, a
    small star does so for the smaller neighbours; repeated until nothing changes, every
    node points at its component's smallest.  Steps are aggregations and joins, the edges never meet in
    one place, and each step is written, so lost executors cost one step at most.
    """
    now = materialised(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "component-edges"
    )
    print_of = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct()
        now = materialised(small, "component-edges")
        row = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if tuple(row) == print_of:
            break
        print_of = tuple(row)
    lowest = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return lowest.unionByName(roots)
