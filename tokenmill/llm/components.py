"""Connected components of a link table, without collecting it.

Every node hooks onto its smallest neighbour, if that is smaller; pointer
jumping (a chain of n links takes about log n rounds) leads every node to the
root of its tree.  The links between different roots are the links of the next
level, where roots are the nodes, until none is left.  Links are thus joined
once a level and repeated ones meet as one; what is jumped are nodes.  Each
step is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm import tables as T


def _roots(labels: DataFrame) -> DataFrame:
    """(node, label) with every label followed to the root of its tree."""
    while True:
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = T.store(labels.join(jump, "label").select("node", "further", (F.col("further") != F.col("label")).alias("moved")), "labels")
        labels = new.select("node", F.col("further").alias("label"))
        if new.where("moved").isEmpty():
            return labels


def _mapped(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The different links between the labels of both ends, a < b; nodes without a label stand for themselves."""
    for end in "a", "b":
        links = (links.join(labels.select(F.col("node").alias(end), "label"), end, "left")
                 .withColumn(end, F.coalesce("label", end)).drop("label"))
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _followed(labels: DataFrame, further: DataFrame) -> DataFrame:
    """``labels`` with each label replaced by its own in ``further``, if it has one."""
    further = further.select(F.col("node").alias("label"), F.col("label").alias("further"))
    return labels.join(further, "label", "left").select("node", F.coalesce("further", "label").alias("label"))


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links(a, b)``; label is the smallest
    node reachable.  No links: no rows."""
    edges = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges, labels = T.store(edges, "links"), None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node")
        roots = _roots(T.store(hooks, "labels"))
        labels = roots if labels is None else T.store(_followed(labels, roots), "labels")
        edges = T.store(_mapped(edges, roots), "links")
        if edges.isEmpty():
            return labels


def extend(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, label) after further links (a, b)."""
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    new = nodes.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
    return T.store(_followed(labels.union(new), components(_mapped(links, labels))), "labels")
