"""Finding things: key words, vectors, pages of lists, and the index that is kept up to date."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.text import clipped, keyword_hits


def by_keywords(pages: DataFrame, text: str, words: list[str], min_hits: int = 1, all_words: bool = False, top: int | None = None, order: str = "seq") -> DataFrame:
    """Pages with enough of the words, the ones with most first; all pages if there are no words."""
    distinct = list(dict.fromkeys(w.lower() for w in words if w.strip()))
    if not distinct:
        return pages.withColumn("hits", F.lit(0))
    rows = pages.withColumn("hits", keyword_hits(text, distinct)).where(F.col("hits") >= (len(distinct) if all_words else min_hits))
    return rows.orderBy(F.desc("hits"), order).limit(top) if top else rows


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def _units(vectors) -> np.ndarray:
    """Directions of vectors of one length, in doubles."""
    m = np.stack([np.asarray(v, np.float64) for v in vectors])
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _best_of_blocks(k: int):
    """A pandas group of one block of each side: side (0 index, 1 queries), id, vector. The k best of the block for each query."""

    def run(rows):
        side, ids = rows["side"].to_numpy(), rows["id"].to_numpy()
        out = {"query_id": [], "id": [], "score": []}
        if 0 < side.sum() < len(side):
            held, names = _units(rows["vector"][side == 0]), ids[side == 0]
            asked, queries = _units(rows["vector"][side == 1]), ids[side == 1]
            for at in range(0, len(asked), 256):
                near = asked[at : at + 256] @ held.T
                least = -np.partition(-near, min(k, near.shape[1]) - 1, axis=1)[:, min(k, near.shape[1]) - 1]
                for i, (row, low) in enumerate(zip(near, least, strict=True)):
                    # a product's last bits depend on the place in the block: candidates are scored again, pair by pair, so that copies tie
                    some = np.flatnonzero(row >= low - 1e-9)
                    scores = (held[some] * asked[at + i]).sum(axis=1)
                    first = np.lexsort((names[some], -scores))[:k]
                    out["query_id"] += [queries[at + i]] * len(first)
                    out["id"] += names[some][first].tolist()
                    out["score"] += scores[first].tolist()
        return type(rows)({"query_id": np.array(out["query_id"], np.int64), "id": np.array(out["id"], np.int64), "score": np.array(out["score"], np.float64)})

    return run


def nearest(queries: DataFrame, index: DataFrame, k: int, block: int = 8192, query_block: int = 2048) -> DataFrame:
    """(query_id, id, score, rank): exact top k by cosine, ties by id.

    ``queries`` has (query_id, vector), ``index`` (id, vector), ids are whole numbers.
    Both sides are dealt into blocks of a bounded number of rows by their counts; each
    two blocks meet in one task, as a product of matrices, and hand on k rows a query.
    Vectors that are null, empty, zero or hold null or non-finite components take no
    part; vectors of different lengths don't meet.
    """
    usable = F.col("vector").isNotNull() & F.forall("vector", lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")), F.lit(False))) & F.exists("vector", lambda x: x != 0)
    asked = queries.where(usable).select(F.col("query_id").cast("long").alias("id"), "vector", F.size("vector").alias("dim"))
    held = index.where(usable).select(F.col("id").cast("long").alias("id"), "vector", F.size("vector").alias("dim"))
    sizes = asked.agg(F.count("*")).first()[0], held.agg(F.count("*")).first()[0]
    n_queries, n_rows = max(1, -(-sizes[0] // query_block)), max(1, -(-sizes[1] // block))
    deal = lambda n: F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = held.withColumn("r", deal(n_rows)).select("dim", "r", every(n_queries).alias("q"), F.lit(0).alias("side"), "id", "vector")
    right = asked.withColumn("q", deal(n_queries)).select("dim", every(n_rows).alias("r"), "q", F.lit(1).alias("side"), "id", "vector")
    found = left.unionByName(right).groupBy("dim", "r", "q").applyInPandas(_best_of_blocks(k), "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(hits: DataFrame, documents: DataFrame, threshold: float = 0.0, length: int = 500) -> DataFrame:
    """Hits at or above the threshold with their documents, text clipped; a hit without a document goes."""
    kept = hits.where(F.col("score") >= threshold).withColumnRenamed("id", "doc_id")
    return kept.join(documents, "doc_id").select("query_id", "rank", "doc_id", F.round("score", 4).alias("score"), clipped("text", length).alias("text"))


def listing(rows: DataFrame, order: list[Column], offset: int, limit: int, contains: tuple[str, str] | None = None, equals: dict[str, str] | None = None) -> DataFrame:
    """A page of a filtered list, with the total of the filtered rows."""
    if contains:
        rows = rows.where(F.contains(F.col(contains[0]), F.lit(contains[1])))
    for c, value in (equals or {}).items():
        rows = rows.where(F.col(c) == value)
    total = rows.agg(F.count("*").alias("total"))
    return rows.orderBy(*order).offset(offset).limit(limit).crossJoin(F.broadcast(total))


def index_entries(documents: DataFrame) -> DataFrame:
    """What the vector index stores of documents (id, url, title, text): lengths are bounded, a blank text is one space."""
    text = F.when(F.trim(F.coalesce("text", F.lit(""))) == "", F.lit(" ")).otherwise(F.substring("text", 1, 500))
    return documents.select(F.col("id").cast("string").alias("id"), F.substring(F.coalesce("url", F.lit("")), 1, 2000).alias("url"), F.substring(F.coalesce("title", F.lit("")), 1, 500).alias("title"), text.alias("snippet"))


def index_increment(documents: DataFrame, last_id: int | Column) -> DataFrame:
    """Documents above the high-water mark that have text."""
    return documents.where((F.col("id") > last_id) & (F.trim(F.coalesce("text", F.lit(""))) != ""))


def upsert_missing(index: DataFrame, entries: DataFrame) -> DataFrame:
    """The index with the entries whose id it lacks."""
    return index.unionByName(entries.join(index.select("id"), "id", "left_anti"))


def delete_ids(index: DataFrame, ids: DataFrame) -> DataFrame:
    return index.join(ids.select("id"), "id", "left_anti")


def clear(index: DataFrame) -> DataFrame:
    """An index of the same columns without rows."""
    return index.limit(0)


def distance_score(distance: Column, metric: str = "cosine") -> Column:
    """The score of a distance: 1 - d for cosine, 1 / (1 + d) for others."""
    return 1 - distance if metric == "cosine" else 1 / (1 + distance)


def latest_crawls(crawls: DataFrame, original_url: str, limit: int = 10) -> DataFrame:
    """The last crawls that started from an address, the newest first."""
    return crawls.where(F.col("original_url") == original_url).orderBy(F.desc("crawled_at"), F.desc("id")).limit(limit)


def task_list(tasks: DataFrame, kind: str | None = None, limit: int = 50) -> DataFrame:
    """Tasks, of one type if it is named, the newest first."""
    rows = tasks if kind is None else tasks.where(F.col("type") == kind)
    return rows.orderBy(F.desc("created_at"), F.desc("task_id")).limit(limit)
