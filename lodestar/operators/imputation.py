"""Missing brands from the nearest neighbours: blocked candidates, weighted vote, application."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.text import ENTITY_WEIGHTS, blank, blank_trimmed, coarse_key, confidence_band, normal_bound, normal_field, normal_similarity, quick_fields, quick_score
from lodestar.storage import Scratch

FIELDS = ["product_model", "manufacturer", "series", "category"]
#: An asked row has no brand, so the brand's weight never counts.
_WEIGHTS = {name: weight for name, weight in ENTITY_WEIGHTS.items() if name != "brand"}


def _prepared(rows: DataFrame) -> DataFrame:
    """Rows with their quick fields, and their fields as they are compared."""
    return rows.withColumns(quick_fields()).withColumns({c: normal_field(c) for c in _WEIGHTS})


def _neighbours(asked: DataFrame, known: DataFrame, on: list[str], k: int, quick: float | None) -> DataFrame:
    """The k best scored candidates of each asked row in each part; ``asked`` has qid and ``floor``, ``known`` has cid and brand.

    A pair whose lengths alone keep its score below the floor is not compared. Tasks
    follow from the session's setting, since few rows make many pairs.
    """
    parts = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    q, c = (side.repartition(parts, *on).alias(name) for side, name in ((asked, "q"), (known, "c")))
    met = q.join(c, reduce(lambda x, y: x & y, (F.col(f"q.{f}") == F.col(f"c.{f}") for f in on)))
    met = met.where(F.col("floor").isNull() | (normal_bound("q.", "c.", _WEIGHTS) >= F.col("floor")))
    if quick is not None:
        met = met.where(quick_score("q.", "c.") >= quick)
    return met.select("qid", F.col("c.brand").alias("brand"), normal_similarity("q.", "c.", _WEIGHTS).alias("score"), "cid")


def knn_candidates(entities: DataFrame, k: int = 5, quick: float = 0.3, salts: int = 16) -> DataFrame:
    """(qid, brand, score, cid, rank): up to k best labelled rows for each distinct unlabelled description.

    A description is compared within its block; one of a block of fewer than 2k rows,
    or with fewer than k candidates past the quick score, is compared with all rows.
    Rows of equal description are compared once: only the first k of them can be
    among the nearest k, so no more of a repeated row is ever joined.  Labelled rows are
    dealt to ``salts`` parts, so that a block with many of the rows is no single task;
    the first part gives each description a score to beat, and in the others only pairs
    that can reach it by their lengths are compared.
    """
    block = coarse_key("manufacturer", "category", "product_model")
    labelled = entities.where(~blank_trimmed("brand")).select(F.col("seq").alias("cid"), "brand", *FIELDS, block.alias("block"))
    sizes = labelled.groupBy("block").agg(F.count("*").alias("rows"))
    first = Window.partitionBy(*FIELDS).orderBy("cid")
    per = _prepared(labelled.withColumn("copy", F.row_number().over(first)).where(F.col("copy") <= k).drop("copy"))
    copies = labelled.groupBy("block", *FIELDS).agg(F.count("*").alias("copies")).withColumns(quick_fields())
    asked = entities.where(blank_trimmed("brand")).groupBy(*FIELDS, block.alias("block")).agg(F.min("seq").alias("qid"))
    asked = _prepared(asked.join(sizes, "block", "left").withColumn("wide", F.coalesce("rows", F.lit(0)) < 2 * k).drop("rows"))
    narrow = asked.where("NOT wide")
    # how many candidates pass the quick score counts every row, repeated ones too; it depends on the quick fields only
    fields = ["block", "q_start", "q_maker", "q_category"]
    kinds = copies.groupBy(*fields).agg(F.sum("copies").alias("copies"))
    within = narrow.select(*fields).distinct().alias("q").join(kinds.alias("c"), "block").where(quick_score("q.", "c.") >= quick)
    enough = within.groupBy(*(F.col(f) if f == "block" else F.col(f"q.{f}").alias(f) for f in fields)).agg(F.sum("copies").alias("n")).where(F.col("n") >= k).select(*fields)
    per = per.withColumn("salt", F.pmod(F.xxhash64("cid"), F.lit(salts)))
    inside = narrow.join(enough, fields, "left_semi")
    everywhere = asked.where("wide").unionByName(narrow.join(enough, fields, "left_anti"))
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "cid")

    def compared(low: int, high: int, floors: DataFrame | None) -> DataFrame:
        """The k best among the parts from ``low`` to below ``high``."""
        parts = F.explode(F.sequence(F.lit(low).cast("long"), F.lit(high - 1).cast("long")))
        known = per.where(F.col("salt").between(low, high - 1))
        found = []
        for rows, on, least in ((inside, ["block", "salt"], quick), (everywhere, ["salt"], None)):
            rows = rows.withColumn("floor", F.lit(None).cast("double")) if floors is None else rows.join(floors, "qid", "left")
            found.append(_neighbours(rows.withColumn("salt", parts), known, on, k, least))
        return found[0].unionByName(found[1]).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    # the k-th best score of the first part is a bound for all others
    first = Scratch(entities.sparkSession, "neighbours").save(compared(0, 1, None), "first")
    floors = first.where(F.col("rank") == k).select("qid", F.col("score").alias("floor"))
    pairs = first.drop("rank").unionByName(compared(1, salts, floors).drop("rank"))
    # scores of 0 rank behind all others; dropping them last keeps the score from being computed for a join condition as well
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).where("score > 0")


def weighted_vote(neighbours: DataFrame, key: str, label: str) -> DataFrame:
    """(key, inferred, confidence): the label of the largest sum of squared scores; of equals the one whose first vote ranks higher.

    A key has k neighbours at most; their scores are added in the order of their ranks, so that sums don't depend on how rows arrive.
    """
    added = lambda terms: F.aggregate(F.array_sort(terms), F.lit(0.0), lambda total, t: total + t["x"])
    votes = neighbours.groupBy(key, label).agg(added(F.collect_list(F.struct("rank", (F.col("score") * F.col("score")).alias("x")))).alias("weight"), F.min("rank").alias("first_rank"))
    total = added(F.collect_list(F.struct("first_rank", F.col("weight").alias("x"))))
    summed = votes.groupBy(key).agg(F.max_by(label, F.struct(F.col("weight"), -F.col("first_rank"))).alias("inferred"), F.max("weight").alias("best"), total.alias("total"))
    return summed.select(key, "inferred", F.when(F.col("total") > 0, F.col("best") / F.col("total")).otherwise(0.0).alias("confidence"))


def impute_brands(entities: DataFrame, k: int = 5, high: float = 0.75, medium: float = 0.6) -> DataFrame:
    """All rows with their brand, given or inferred; UNKNOWN where nothing can be inferred."""
    votes = weighted_vote(knn_candidates(entities, k), "qid", "brand")
    asked = entities.where(blank_trimmed("brand")).groupBy(*FIELDS).agg(F.min("seq").alias("qid"))
    answers = asked.join(votes, "qid", "left").drop("qid")
    missing = blank_trimmed("brand")
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"a.{c}")) for c in FIELDS]
    open_rows = entities.where(missing).alias("e").join(answers.alias("a"), same, "left").select("e.*", "inferred", F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
    done = entities.where(~missing).select("*", F.lit(None).cast("string").alias("inferred"), F.lit(None).cast("double").alias("confidence"))
    both = open_rows.unionByName(done)
    was_missing = blank_trimmed("brand")
    return both.select(
        *(c for c in entities.columns if c != "brand"),
        F.when(was_missing, F.coalesce("inferred", F.lit("UNKNOWN"))).otherwise(F.col("brand")).alias("brand"),
        (was_missing & F.col("inferred").isNotNull()).alias("brand_inferred"),
        F.round("confidence", 6).alias("brand_confidence"),
        F.when(was_missing, confidence_band("confidence", high, medium)).alias("confidence_level"),
    )


def representatives(entities: DataFrame, per_brand: int = 3) -> DataFrame:
    """The most complete rows of each brand, the first of equals."""
    score = F.lit(0)
    for c, weight in (("manufacturer", 2), ("product_model", 2), ("category", 1), ("series", 1)):
        score += F.when(~blank(c), weight).otherwise(0)
    rows = entities.where(~blank("brand")).withColumn("completeness", score)
    order = Window.partitionBy("brand").orderBy(F.desc("completeness"), "seq")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_brand)
