"""Connected components of a graph given by its edges, by contraction with written rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.tables import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the edges (a, b).

    In each round every node moves to the neighbour that comes first in a random order of that round, or
    stays if it comes first itself; edges are carried over to where their ends have moved. The number
    of nodes shrinks geometrically whatever the shape. Minima combine before their shuffle, so a node with
    very many edges is no hot key; each round is written, so nothing is repeated when an executor is lost.
    """
    edges = stage(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("at", F.col("node"))
    number = 0
    while not edges.isEmpty():
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(number)).alias("rank"), F.col(c).alias("to"))  # noqa: E731, B023
        ends = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = stage(
            ends.groupBy("a").agg(F.min(order("b")).alias("near"))
            .select(F.col("a").alias("old"), F.least(F.col("near"), order("a"))["to"].alias("new")),
            "moves",
        )
        moved = lambda df, c: (
            df.join(moves, df[c] == moves["old"], "left").withColumn(c, F.coalesce("new", c)).drop("old", "new")  # noqa: B023
        )
        labels = stage(moved(labels, "at"), "labels")
        carried = moved(moved(edges, "a"), "b").where("a <> b")
        edges = stage(carried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        number += 1
    smallest = stage(labels.groupBy("at").agg(F.min("node").alias("component")).withColumnRenamed("at", "of"), "smallest")
    return labels.join(smallest, F.col("at") == F.col("of")).select("node", "component")
