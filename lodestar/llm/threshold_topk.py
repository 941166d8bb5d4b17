"""Exact top-k by inner product with the threshold algorithm over sorted lists.

The rows are dealt into blocks of bounded size, the queries too, and each pair of
blocks is one task's work.  Within a block of rows every dimension has its list of
rows sorted by that component.  A query walks all lists in step, from the end that
its own component favours, scores every row that it meets, and stops as soon as the
best score that an unseen row could still have, the sum over the lists of what the
walk has come to, cannot beat its k-th result (an equal score could still win by a
smaller id, so the walk stops only below it).  A sixteenth of the blocks is walked
first; the k-th best scores found there are bounds that go with the queries to the
others, where most walks then end much sooner.  The blocks' winners are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.sorted_projection import rows_of
from lodestar.storage import Scratch

_LARGEST = 2**63 - 1


def quantised(vector: np.ndarray, scale: int) -> list[int]:
    """floor(scale * x) of each component, as exact integers."""
    scaled = np.floor(vector * scale)
    if len(scaled) and not np.abs(scaled).max() < 2**62:
        return [int(np.floor(x)) if np.isfinite(x) else int(y) * scale for x, y in zip(scaled.tolist(), vector.tolist(), strict=True)]
    return scaled.astype(np.int64).tolist()


class SortedLists:
    """The rows of a block, with a list per dimension sorted by component."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.lists = np.argsort(self.values, axis=0, kind="stable")  # ascending
        self.sorted = np.take_along_axis(self.values, self.lists, axis=0)
        self.exact = None  # the same values as doubles, where no partial sum can leave their integers
        if len(ids) and self.values.dtype != object and int(np.abs(self.values).max()) < 2**20 and self.values.shape[1] < 2**12:
            self.exact = self.values.astype(np.float64)

    def top(self, query: np.ndarray, query_id: int | None, k: int, step: int = 32, floor: int | None = None) -> tuple[list[int], list[int]]:
        """Ids and scores of the k best rows of other ids; ties go to smaller ids.

        With a ``floor``, k rows of at least that score are known elsewhere, so rows below it may be left out.
        """
        n = len(self.ids)
        used = np.flatnonzero(query)
        if not len(used) or not n:
            own = self.ids[self.ids != query_id][:k].tolist() if floor is None or floor <= 0 else []
            return own, [0] * len(own)
        down = query[used] > 0
        weights = query[used]
        seen = np.zeros(n, bool)
        best_ids, best_scores = np.empty(0, np.int64), np.empty(0, self.values.dtype)
        depth = 0
        while depth < n:
            upto = min(n, depth + step)
            ranks = np.where(down[None, :], n - 1 - np.arange(depth, upto)[:, None], np.arange(depth, upto)[:, None])
            met = np.zeros(n, bool)
            met[self.lists[ranks, used[None, :]].ravel()] = True
            new = np.flatnonzero(met & ~seen)
            seen |= met
            new_ids = self.ids[new]
            scores = self._scores(new, query)
            if query_id is not None:
                other = new_ids != query_id
                new_ids, scores = new_ids[other], scores[other]
            best_ids, best_scores = np.concatenate((best_ids, new_ids)), np.concatenate((best_scores, scores))
            order = np.lexsort((best_ids, -best_scores))[:k]
            best_ids, best_scores = best_ids[order], best_scores[order]
            depth = upto
            bound = self.sorted[ranks[-1], used] @ weights
            if len(best_ids) == k and bound < best_scores[-1] or floor is not None and bound < floor:
                break
            step = min(2 * step, 1024)
        if floor is not None:
            best_ids, best_scores = best_ids[best_scores >= floor], best_scores[best_scores >= floor]
        return best_ids.tolist(), best_scores.tolist()

    def _scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        if self.exact is None:
            return self.values[rows] @ query
        return (self.exact[rows] @ query.astype(np.float64)).astype(np.int64)


def _matrix(vectors: list[list[int]], width: int) -> np.ndarray:
    """Rows padded with zeros; 64-bit integers where no inner product can leave their range, else exact ones."""
    largest = max((abs(v) for row in vectors for v in row), default=0)
    kind = np.int64 if largest * largest * max(width, 1) < 2**62 else object
    out = np.zeros((len(vectors), width), kind)
    for i, row in enumerate(vectors):
        out[i, : len(row)] = row
    return out


def _search(k: int):
    """pandas group of one pair of blocks: side (0 rows, 1 queries), vec_id, values, floor."""

    def run(rows):
        rows = rows.sort_values(["side", "vec_id"])
        side, ids = rows["side"].to_numpy(), rows["vec_id"].to_numpy()
        values = [list(map(int, v)) for v in rows["values"]]
        floors = [None if x is None or x != x else int(x) for x in rows["floor"].tolist()]
        m = _matrix(values, max(map(len, values), default=0))
        lists = SortedLists(ids[side == 0], m[side == 0])
        out: list[tuple[int, int, int]] = []
        for at in np.flatnonzero(side == 1).tolist():
            query_id = int(ids[at])
            if lists.exact is not None and np.abs(m[at]).max(initial=0) >= 2**20:
                lists.exact = None
            found, scores = lists.top(m[at], query_id, k, floor=floors[at])
            out += [(query_id, i, max(-_LARGEST - 1, min(_LARGEST, int(s)))) for i, s in zip(found, scores, strict=True)]
        return type(rows)(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def _first(k: int, found: DataFrame) -> DataFrame:
    """The k best of each query's rows, with their ranks."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = 10, scale: int = 1024, block: int = 8192, query_block: int = 2048
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for every row whose id is divisible by ``every``.

    Components count as floor(scale * x); the score is the integer inner product,
    ties go to smaller ids, a query does not find rows of its own id, and there are
    fewer than ``k`` rows only where the table has no more.  Rows that share an id are
    candidates each by itself, so an id can come more than once; as queries they are
    one, whose results are the best of all its rows' scores.  Vectors that are null or
    hold null or non-finite components, and rows with a null id, take no part; a
    shorter vector counts as padded with zeros.  Scores beyond 64 bits come as the
    largest ones.  Columns other than the two named are ignored.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    kind = "array<long>"

    def quantise(batches):
        for batch in batches:
            found = [None if x is None else quantised(x, scale) for x in rows_of(batch.column(1))]
            clipped = [None if x is None else [max(-(1 << 62), min(1 << 62, v)) for v in x] for x in found]
            keep = pa.array([x is not None for x in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(clipped, pa.list_(pa.int64()))], names=["vec_id", "values"]).filter(keep)

    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")).where("vec_id IS NOT NULL")
    # blocks by a number of the row, saved with it, so that neither an id nor a vector that comes often fills one
    numbered = source.mapInArrow(quantise, f"vec_id long, values {kind}").withColumn("n", F.monotonically_increasing_id())
    rows = scratch.save(numbered, "rows")
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    total, queries = rows.agg(F.count("*"), F.count_if(is_query)).first()
    n_rows, n_queries = max(1, -(-total // block)), max(1, -(-queries // query_block))
    deal = lambda n, salt: F.pmod(F.xxhash64("n", F.lit(salt)), F.lit(n)).cast("int")
    held = rows.select(deal(n_rows, 1).alias("r"), F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("q"), F.lit(0).alias("side"), "vec_id", "values", F.lit(None).cast("long").alias("floor"))
    asked = scratch.save(rows.where(is_query).select(deal(n_queries, 2).alias("q"), "vec_id", "values"), "asked")

    def search(low: int, high: int, queries: DataFrame) -> DataFrame:
        """What rows in blocks from ``low`` to below ``high`` give."""
        spread = queries.select(F.explode(F.sequence(F.lit(low), F.lit(high - 1))).alias("r"), "q", F.lit(1).alias("side"), "vec_id", "values", "floor")
        both = held.where(F.col("r").between(low, high - 1)).unionByName(spread)
        return both.groupBy("r", "q").applyInPandas(_search(k), "query_id long, vec_id long, score long")

    some = -(-n_rows // 16)
    best = _first(k, search(0, some, asked.withColumn("floor", F.lit(None).cast("long"))))
    if some < n_rows:
        best = scratch.save(best, "first")
        floors = best.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
        others = search(some, n_rows, asked.join(floors, "vec_id", "left"))
        best = _first(k, best.drop("rank").unionByName(others))
    best = scratch.save(best.select("query_id", "rank", "vec_id", "score"), "best")
    scratch.clear(best)
    return best
