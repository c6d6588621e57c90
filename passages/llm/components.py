"""Connected components of a table of edges, by hooking to minima and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passages.llm.common import small, store

# Tables of labels of at most so many rows are shipped; beyond, joins are shuffled.
SHIPPED_ROWS = 250_000


def follow(table: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """``table`` with ``column`` replaced by its parent, where it has one."""
    found = parents.select(F.col("node").alias("_node"), F.col("component").alias("_parent"))
    joined = table.join(found, table[column] == F.col("_node"), "left")
    return joined.select(
        *[F.coalesce("_parent", column).alias(c) if c == column else F.col(c) for c in table.columns]
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)``: the smallest id reachable from each node of ``(a, b)``.

    In a round every node hooks to its smallest neighbour, if that is smaller than itself;
    parents become their parents' parents until all are roots, so a chain of ``n`` hooks takes
    ``log2(n)`` jumps; edges then join components, and those inside one go.
    Minima are combined before the shuffle. Tables of parents are shipped while small and
    else joined by shuffles, whose skewed keys adaptive execution splits. Each round goes
    on from files. An empty table has no nodes.
    """
    current = edges.where("a <> b").select("a", "b")
    labels = None
    while True:
        both = current.union(current.select("b", "a")).toDF("node", "other")
        hooks = store(
            both.groupBy("node").agg(F.least(F.min("other"), "node").alias("component")), "hooks"
        )
        parents = hooks
        while True:  # each jump doubles the steps, until all have reached a root
            moved = small(parents.where("component < node"), SHIPPED_ROWS)
            jumped = follow(parents.withColumn("before", F.col("component")), "component", moved)
            jumped = store(jumped, "parents")
            parents = jumped.select("node", "component")
            if jumped.where("component < before").isEmpty():
                break
        shipped = small(parents, SHIPPED_ROWS)
        labels = parents if labels is None else store(
            follow(labels, "component", shipped), "labels"
        )
        for end in ("a", "b"):
            current = follow(current, end, shipped)
        current = store(current.where("a <> b").distinct(), "edges")
        if current.isEmpty():
            return labels
