"""Brand, series and model candidates between the stages: snapshots, keys, one primary brand, defaults of products.

Rows are candidates with a ``seq`` that says in which order they came; lists keep the
order of first appearance.  Where the rules speak of one document, ``doc`` names it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.text import Name, blank_trimmed, brand_key, distinct_list, model_name, pair_key, plain_key, series_key, trimmed
from lodestar.operators import merge, reviews
from lodestar.operators.merge import ordered_distinct

#: Fixed value: the category of a product that has none.
DEFAULT_CATEGORY = "暖通空调"
PRODUCT_TEXTS = ["brand", "category", "series", "product_model", "manufacturer", "refrigerant", "energy_efficiency_grade"]
PRODUCT_LISTS = ["features", "key_components", "fact_text", "evidence"]


def _first_filled(*keys):
    return F.coalesce(*(F.nullif(k, F.lit("")) for k in keys))


def brand_snapshot(candidates: DataFrame, doc: str = "doc", seq: str = "seq") -> DataFrame:
    """(doc, brand_key, name, evidence, pages, rank): one row for each brand key, those of most pages first, then as they came.

    The name is that of the first mention.
    """
    named = candidates.withColumn("name", trimmed("name")).where("name <> ''").withColumn("brand_key", _first_filled(brand_key("name"), plain_key("name")))
    rows = named.where("brand_key IS NOT NULL").groupBy(doc, "brand_key")
    rows = rows.agg(F.min_by("name", seq).alias("name"), F.min(seq).alias(seq), ordered_distinct("evidence", seq).alias("evidence"), ordered_distinct("pages", seq).alias("pages"))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(doc).orderBy(F.size("pages").desc(), seq)))


def primary_brand(snapshot: DataFrame, chosen: DataFrame, doc: str = "doc") -> DataFrame:
    """The first brand of each document's snapshot that was chosen, else its first one. chosen: doc, name."""
    picked = chosen.select(doc, brand_key("name").alias("brand_key")).distinct().withColumn("chosen", F.lit(True))
    rows = snapshot.join(picked, [doc, "brand_key"], "left").withColumn("chosen", F.coalesce("chosen", F.lit(False)))
    order = Window.partitionBy(doc).orderBy(F.desc("chosen"), "rank")
    return rows.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")


def merge_chunk_series(found: DataFrame, doc: str = "doc", seq: str = "seq") -> DataFrame:
    """Series that several chunks of a document named, once for each name; one without pages gets those of its chunks.

    found: doc, brand, name, evidence, pages, chunk_pages, seq.
    """
    rows = found.withColumn("name", trimmed("name")).where("name <> ''").groupBy(doc, "brand", plain_key("name").alias("key"))
    rows = rows.agg(F.min_by("name", seq).alias("name"), F.min(seq).alias(seq), *(ordered_distinct(c, seq).alias(c) for c in ("evidence", "pages", "chunk_pages")))
    return rows.withColumn("pages", F.when(F.size("pages") == 0, F.col("chunk_pages")).otherwise(F.col("pages"))).drop("key", "chunk_pages")


def keyed_series(series: DataFrame) -> DataFrame:
    """Series of brands with their keys; those without a name go."""
    rows = series.withColumn("name", trimmed("name")).where("name <> ''")
    return rows.withColumns({"pair_key": pair_key("brand", "name"), "series_key": series_key("name"), "evidence": distinct_list("evidence"), "pages": distinct_list("pages")})


def keyed_models(models: DataFrame, doc: str = "doc", seq: str = "seq") -> DataFrame:
    """(doc, brand, series, pair_key, name, model_key, evidence, pages): models of a series in their canonical form, each once.

    This is also the explicit view of the models by pair.
    """
    rows = models.withColumn("name", model_name("name")).where("name <> ''").groupBy(doc, "brand", "series", "name")
    rows = rows.agg(F.min(seq).alias(seq), *(ordered_distinct(c, seq).alias(c) for c in ("evidence", "pages")))
    return rows.select(doc, "brand", "series", pair_key("brand", "series").alias("pair_key"), "name", pair_key("brand", "series", "name").alias("model_key"), "evidence", "pages", seq)


def only_brand(brands: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, only): documents with exactly one brand, that has a name."""
    return brands.groupBy(doc).agg(F.count("*").alias("n"), F.min(trimmed("name")).alias("only")).where("n = 1 AND only <> ''").select(doc, "only")


def _under_one_brand(rows: DataFrame, brands: DataFrame, doc: str) -> DataFrame:
    """Rows under their document's only brand, and whether that changed them."""
    out = rows.join(only_brand(brands, doc), doc, "left")
    out = out.withColumn("moved", F.col("only").isNotNull() & ~trimmed("brand").eqNullSafe(F.col("only")))
    return out.withColumn("brand", F.coalesce("only", "brand"))


def single_brand_series(brands: DataFrame, series: DataFrame, doc: str = "doc", seq: str = "seq") -> DataFrame:
    """(doc, brand, name, series_key, pair_key, aliases, evidence, pages, changed).

    In a document of one brand all series come under it and are merged by the key of
    the series; in others each stays under its brand, in its own words.
    """
    rows = _under_one_brand(keyed_series(series), brands, doc)
    changed = rows.groupBy(doc).agg(F.max("moved").alias("changed"))
    merged = reviews.merge_series(rows.where("only IS NOT NULL"), [doc, "brand"], seq).drop("series_key")
    kept = rows.where("only IS NULL").select(doc, "brand", "name", F.array("name").alias("aliases"), "evidence", "pages", seq)
    out = merged.select(kept.columns).unionByName(kept)
    return out.join(changed, doc).select(doc, "brand", "name", series_key("name").alias("series_key"), pair_key("brand", "name").alias("pair_key"), "aliases", "evidence", "pages", "changed")


def single_brand_models(brands: DataFrame, models: DataFrame, doc: str = "doc", seq: str = "seq") -> DataFrame:
    """:func:`keyed_models` with all models of a document of one brand under it, and whether that changed any of the pair's."""
    rows = _under_one_brand(models, brands, doc)
    changed = rows.where(model_name("name") != "").groupBy(doc, "brand", "series").agg(F.max("moved").alias("changed"))
    return keyed_models(rows, doc, seq).join(changed, [doc, "brand", "series"])


def single_brand_conflicts(brands: DataFrame, conflicts: DataFrame, doc: str = "doc") -> DataFrame:
    """Candidates of model conflicts (doc, brand, series, model_key, pair_key, ...) re-keyed to their document's only brand."""
    rows = _under_one_brand(conflicts, brands, doc)
    return rows.withColumn("pair_key", pair_key("brand", "series")).withColumnRenamed("moved", "changed").drop("only")


def product_defaults(products: DataFrame, brand: Name, series: Name, pages: Name) -> DataFrame:
    """Products with every field filled: the brand and series that they were found under, a category, where they are from.

    ``pages`` is the list of pages read; texts are trimmed and models canonical; a missing list is empty.
    """
    empty = F.array().cast("array<string>")
    rows = products
    for c in PRODUCT_TEXTS:
        rows = rows if c in rows.columns else rows.withColumn(c, F.lit(None).cast("string"))
    for c in PRODUCT_LISTS:
        rows = rows if c in rows.columns else rows.withColumn(c, F.lit(None).cast("array<string>"))
    given = {"brand": brand, "series": series, "category": F.lit(DEFAULT_CATEGORY)}
    or_given = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(given[c]) if isinstance(given[c], str) else given[c]) if c in given else F.col(c)
    found = F.col(pages) if isinstance(pages, str) else pages
    origin = F.array(F.concat(F.lit("pages: ["), F.array_join(F.transform(found, lambda p: F.concat(F.lit("'"), p.cast("string"), F.lit("'"))), ", "), F.lit("]")))
    texts = {c: trimmed(or_given(c)) for c in PRODUCT_TEXTS} | {"product_model": model_name("product_model")}
    lists = {c: F.coalesce(F.col(c), empty) for c in PRODUCT_LISTS} | {"evidence": distinct_list(F.when(F.size(F.coalesce("evidence", empty)) == 0, origin).otherwise(F.col("evidence")))}
    return rows.withColumns(texts | lists)


def settled_brands(voted: DataFrame, answers: DataFrame, known: DataFrame, row: str = "row_id") -> DataFrame:
    """Votes of neighbours and answers of a model, joined by row: an answer counts if it is a known brand, else the vote stays.

    voted: row, inferred, confidence. answers: row, brand, confidence. known: brand.
    Adds ``method`` (llm, knn_only or none) and the vote that an answer replaced.
    """
    accepted = answers.select(row, trimmed("brand").alias("_answer"), F.col("confidence").alias("_sure")).where("_answer <> ''")
    accepted = accepted.join(known.select(trimmed("brand").alias("_answer")).distinct(), "_answer", "left_semi").dropDuplicates([row])
    out = voted.join(accepted, row, "left")
    took = F.col("_answer").isNotNull()
    return out.select(
        *(c for c in voted.columns if c not in ("inferred", "confidence")),
        F.coalesce("_answer", "inferred").alias("inferred"),
        F.when(took, F.col("_sure")).otherwise(F.col("confidence")).alias("confidence"),
        F.when(took, "llm").when(~blank_trimmed("inferred"), "knn_only").otherwise("none").alias("method"),
        F.when(took, F.col("inferred")).alias("voted_brand"),
        F.when(took, F.col("confidence")).alias("voted_confidence"),
    )


def corrected_categories(products: DataFrame, doc: str, by_word, by_label=None, seq: str = "seq") -> DataFrame:
    """Categories by, in order: an explicit label, a word in the model, a word in the series, the document's main one where
    the series is its main series (even over a category that is given), and else as they are.

    ``by_word`` and ``by_label`` give a category for a column, or null.
    """
    context = merge.main_values(products, [doc], "category", seq).join(merge.main_values(products, [doc], "series", seq), doc, "full")
    rows = products.join(context, doc, "left")
    ways = [by_label("product_model")] if by_label else []
    ways += [by_word("product_model"), by_word("series"), F.when(trimmed("series") == F.col("main_series"), F.col("main_category"))]
    return rows.withColumn("category", F.coalesce(*ways, F.col("category")))
