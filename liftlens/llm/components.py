"""Connected components of a link table, as Spark jobs.

Alternating large-star and small-star steps: every step is one aggregation and
one or two joins on the node, links stay between nodes and their smallest known
neighbour, and the number of rounds grows with the logarithm of a component's
diameter.  Each round is written below the shared folder, so lineage stays short
and a lost executor costs one round.  A round's files follow its links and the cores,
not the shuffle partitions: few links leave no crowd of small files and tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

FILE_ROWS = 1 << 20     # links a written file, where there are more files than cores


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); root is the component's smallest node.

    Self-links and repeated links are allowed, null ends are dropped.
    """
    edges = links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where(
        F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") < F.col("v"))).distinct()
    edges = materialize(edges, "components")
    n = edges.count()
    if not n:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    seen = None
    for _ in range(max_rounds):
        files = max(edges.sparkSession.sparkContext.defaultParallelism, -(-n // FILE_ROWS))
        edges = materialize(_small_star(_large_star(edges)).coalesce(files), "components")
        # stable once every node points at a root that points nowhere, and nothing changed
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("bigint")),
                                F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == seen:
            break
        seen, n = state, state[0]
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (itself included)."""
    both = edges.select(F.col("u").alias("n"), F.col("v").alias("m")).union(
        edges.select(F.col("v").alias("n"), F.col("u").alias("m")))
    least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low"))
    return both.where("m > n").join(least, "n").select(F.col("low").alias("u"), F.col("m").alias("v")).where(
        "u < v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("v").agg(F.min("u").alias("low"))
    own = least.select(F.col("low").alias("u"), "v")
    rest = edges.join(least, "v").select(F.col("low").alias("u"), F.col("u").alias("v")).where("u < v")
    return own.union(rest).distinct()
