"""Connected components of links between long ids, by contraction."""

from pyspark.sql import DataFrame, functions as F

from rolecall.sources.sinks import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``: the smallest node reachable.

    In each round every node takes the smallest of itself and its neighbours as its
    parent, and the links are contracted to the parents, until none is left. Minima are taken map-side first, so a node with very
    many links is no bottleneck, and every round is written to the shared folder.
    """
    both = links.select(F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b")).where("a is not null and b is not null")
    both = stage(both.distinct(), "links")
    # as many tasks as the links fill; shuffles still deal by the session's setting
    tasks = 1 + both.count() // 500_000
    kept = lambda df, name: stage(df.coalesce(tasks), name)
    edges = kept(both.where("a <> b"), "links")
    roots = kept(both.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")), "roots")
    while not edges.isEmpty():
        ways = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("w"))
        parents = kept(
            ways.groupBy(F.col("w.a").alias("child")).agg(F.least(F.min("w.b"), F.col("child")).alias("parent")), "parents"
        )
        # two steps up a chain of parents
        upper = parents.select(F.col("child").alias("parent"), F.col("parent").alias("upper"))
        parents = kept(parents.join(upper, "parent").select("child", F.col("upper").alias("parent")), "parents")
        up = lambda df, column: (
            df.join(parents.withColumnsRenamed({"child": column, "parent": "_up"}), column, "left")
            .withColumn(column, F.coalesce("_up", column)).drop("_up")
        )
        roots = kept(up(roots, "root"), "roots")
        edges = kept(up(up(edges, "a"), "b").where("a <> b").distinct(), "links")
    return roots
