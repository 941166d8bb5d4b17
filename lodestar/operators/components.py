"""Connected components over an edge table of any size.

First the edges are dealt into chunks of a bounded number, and each chunk is reduced
to stars around its smallest nodes by union-find.  What several chunks leave is
contracted in rounds: every node tells its larger neighbours about the smallest node
it knows, then its smaller ones.  A round is a grouped minimum (combined map-side)
plus an equi-join whose second side has one row per node, so a hub's rows can be
split by adaptive execution.  Nothing is gathered on the driver but one flag per round.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.storage import Scratch

#: Edges that one task unites in memory.
CHUNK = 250_000


def _stars(batches):
    """Edges (u, v) of one chunk to (node, smallest node of its part)."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if find(x) != x]
    for at in range(0, len(nodes), 10_000):
        some = nodes[at : at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([find(x) for x in some], pa.int64())], names=["u", "v"])


def _is_star_forest(edges: DataFrame) -> bool:
    """Does every node either point to exactly one root or get pointed to?"""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    per_node = ends.groupBy("n").agg((F.sum("out") + F.max("into")).alias("load"))
    return (per_node.agg(F.max("load")).first()[0] or 0) <= 1


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", chunk: int = CHUNK, max_rounds: int = 60, scratch: Scratch | None = None) -> DataFrame:
    """(node, component) for every node that has an edge to another node.

    ``component`` is the smallest node id reachable.  Null ends and self-loops
    are ignored, repeated edges count once, an empty edge table gives an empty
    result.  Columns other than the two named are ignored.  The tables that the result
    reads are in ``scratch``, if one is given, for its owner to delete.
    """
    scratch = scratch or Scratch(edges.sparkSession, "components")
    a, b = F.col(src).cast("long"), F.col(dst).cast("long")
    given = scratch.save(edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")), "given")
    chunks = max(1, -(-given.count() // chunk))
    current = scratch.save(given.repartition(chunks).mapInArrow(_stars, "u long, v long"), "edges")
    scratch.drop(given)
    for _ in range(max_rounds):
        if chunks == 1 or _is_star_forest(current):
            break
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # its two uses below share one exchange
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = scratch.save(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "edges")
        scratch.drop(current)
        current = following
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
