"""Connected components of links, by least labels and pointer jumps over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.shared import release, written


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (a, b of one orderable type); ``root`` is its component's least node.

    Each round, links between roots are replaced by links to the least neighbour, so a star needs two rounds and a chain
    a number that grows with the logarithm of its length. Labels of a round are a written table. Nothing is gathered by
    node but a minimum, so a node with very many links is no burden.
    """
    both = links.where("a <> b").select("a", "b").distinct()
    both = written(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    # each node points to the least of itself and its neighbours
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        jump = labels.select(F.col("node").alias("n"), F.col("root").alias("r"))
        jumped = labels.join(jump, F.col("root") == F.col("n"), "left").select("node", F.least("root", F.coalesce("r", "root")).alias("root"))
        own = jumped.select(F.col("node").alias("n"), F.col("root").alias("r"))
        # the least root that a root's members see next to them becomes its root
        seen = both.join(own, F.col("b") == F.col("n")).groupBy(F.col("a").alias("m")).agg(F.min("r").alias("near"))
        met = jumped.join(seen, F.col("node") == F.col("m"), "left").select("node", "root", F.least("root", F.coalesce("near", "root")).alias("near"))
        pull = met.groupBy(F.col("root").alias("p")).agg(F.min("near").alias("low"))
        new = written(met.join(pull, F.col("root") == F.col("p"), "left").select("node", F.least("near", F.coalesce("low", "near")).alias("root")), "labels")
        changed = new.join(labels.select(F.col("node").alias("n"), F.col("root").alias("r")), F.col("node") == F.col("n")).where("root <> r")
        done = changed.isEmpty()
        release(labels)
        labels = new
        if done:
            release(both)
            return labels


def hooked(links: DataFrame) -> DataFrame:
    """``(node, root)`` of parts of components: the least node at most three links away.

    Nodes of one root are connected; connected nodes may have several. It costs three aggregations, so it can run often.
    """
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(links.select(F.explode(ends).alias("e")).select("e.a", "e.b"), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("root"))
    for _ in range(2):
        seen = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("m")).agg(F.min("root").alias("near"))
        labels = labels.join(seen, F.col("node") == F.col("m")).select("node", F.least("root", "near").alias("root"))
    return labels
