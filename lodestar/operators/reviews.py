"""Series candidates and review verdicts: merging, keeping, redirecting, and what a series gives its products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions import series as S
from lodestar.functions.text import blank_trimmed, col, distinct_list, model_name, series_key, trimmed
from lodestar.operators.merge import ordered_distinct


def merge_series(candidates: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """Candidates (keys, name, evidence, pages) cut apart, sifted, and merged by their key; the best name is shown."""
    parts = candidates.withColumn("name", F.explode(S.split_names("name"))).withColumn("name", S.clean_name("name")).where(S.is_series("name"))
    merged = parts.withColumn("series_key", S.merge_key("name")).where("series_key <> ''").groupBy(*keys, "series_key")
    return merged.agg(
        F.max(S.display_score(F.col("name"))).alias("best"),
        F.array_sort(F.collect_set("name")).alias("aliases"),
        ordered_distinct("evidence", seq).alias("evidence"),
        ordered_distinct("pages", seq).alias("pages"),
        F.min(seq).alias(seq),
    ).select(*keys, "series_key", F.col("best.name").alias("name"), "aliases", "evidence", "pages", seq)


def apply_verdicts(candidates: DataFrame, verdicts: DataFrame, on: list[str], kind: str) -> DataFrame:
    """Candidates that are kept as ``kind`` or have no verdict. verdicts: ``on``, keep, kind and more."""
    found = verdicts.dropDuplicates(on).withColumnsRenamed({"keep": "_keep", "kind": "_kind"})
    rows = candidates.join(found, on, "left")
    return rows.where(F.col("_keep").isNull() & F.col("_kind").isNull() | (F.col("_keep") & (F.col("_kind") == kind))).drop("_keep", "_kind")


def review_series(candidates: DataFrame, verdicts: DataFrame, brand: str = "brand") -> DataFrame:
    """Series after their review, found by merge key, then by plain key; coded names stay even against it.

    verdicts: brand, original, keep, kind, canonical.
    """
    filed = verdicts.withColumn("_key", F.explode(F.array_distinct(F.array(*S.lookup_keys("original"))))).where("_key <> ''")
    filed = filed.groupBy(brand, "_key").agg(F.max(F.struct("original", "keep", "kind", "canonical")).alias("v"))
    rows = candidates.withColumn("_original", S.clean_name("name")).where(S.is_series("_original"))
    rows = rows.withColumn("_k1", F.coalesce(F.nullif(S.merge_key("_original"), F.lit("")), series_key("_original"))).withColumn("_k2", series_key("_original"))
    one = filed.select(brand, F.col("_key").alias("_k1"), F.col("v").alias("v1"))
    two = filed.select(brand, F.col("_key").alias("_k2"), F.col("v").alias("v2"))
    rows = rows.join(one, [brand, "_k1"], "left").join(two, [brand, "_k2"], "left").withColumn("v", F.coalesce("v1", "v2"))
    canonical = F.coalesce(F.nullif(S.clean_name(F.coalesce(F.nullif(trimmed("v.canonical"), F.lit("")), F.col("_original"))), F.lit("")), F.col("_original"))
    rows = rows.withColumn("canonical", F.when(F.col("v").isNull(), F.col("_original")).otherwise(canonical))
    keep = F.col("v").isNull() | (F.coalesce(F.col("v.keep"), F.lit(False)) & (F.col("v.kind") == "series"))
    return rows.where(keep | S.is_coded("_original") | S.is_coded("canonical")).drop("_original", "_k1", "_k2", "v1", "v2", "v")


def redirect_models(models: DataFrame, verdicts: DataFrame, known: DataFrame, confident: float = 0.7, drop_mismatch: bool = False) -> DataFrame:
    """Models of (brand, series, name) after their review, each in the series it belongs to.

    verdicts: brand, series, name, keep, kind, series_guess, redirect_to, confidence.
    known: brand, series. A confident verdict moves a model to another known series, or
    to the one it names as target; without one a model stays.
    """
    rows = models.join(verdicts.withColumnRenamed("kind", "_kind"), ["brand", "series", "name"], "left")
    rows = rows.where(F.col("_kind").isNull() & F.col("keep").isNull() | (F.col("keep") & (F.col("_kind") == "model")))
    targets = known.select("brand", F.col("series").alias("_known"), series_key("series").alias("_key")).dropDuplicates(["brand", "_key"])
    hinted = F.coalesce(F.nullif(trimmed("redirect_to"), F.lit("")), F.nullif(trimmed("series_guess"), F.lit("")))
    rows = rows.withColumn("_hint", hinted).withColumn("_key", series_key("_hint")).join(targets, ["brand", "_key"], "left")
    target = F.when(trimmed("redirect_to") != "", F.coalesce("_known", trimmed("redirect_to"))).otherwise(F.col("_known"))
    rows = rows.withColumn("_target", target)
    other = F.col("_target").isNotNull() & (series_key("_target") != series_key("series"))
    sure = F.coalesce("confidence", F.lit(1.0)) >= confident
    lost = F.lit(drop_mismatch) & ((other & ~sure) | (F.col("_target").isNull() & F.col("_hint").isNotNull()))
    moved = rows.where(~lost).withColumn("redirected", other & sure).withColumn("series", F.when(other & sure, F.col("_target")).otherwise(F.col("series")))
    return moved.select(*models.columns, "redirected")


def add_series_features(products: DataFrame, features: DataFrame, seq: str = "seq") -> DataFrame:
    """What is said of a series, given to its products. features: brand, series, features, fact_text, key_components."""
    lists = ["features", "fact_text", "key_components"]
    per = features.where(~blank_trimmed("brand") & ~blank_trimmed("series")).groupBy(trimmed("brand").alias("_b"), trimmed("series").alias("_s")).agg(*(ordered_distinct(c, seq).alias(f"_{c}") for c in lists))
    rows = products.withColumns({"_b": trimmed("brand"), "_s": trimmed("series")}).join(per, ["_b", "_s"], "left")
    empty = F.array().cast("array<string>")
    for c in lists:
        rows = rows.withColumn(c, distinct_list(F.concat(F.coalesce(c, empty), F.coalesce(f"_{c}", empty))))
    return rows.select(products.columns)


def single_brand_scope(rows: DataFrame, doc: str = "doc") -> DataFrame:
    """Where a document has exactly one brand, all its rows get it; ``brand_changed`` tells which did."""
    per = rows.where(~blank_trimmed("brand")).groupBy(doc).agg(F.min("brand").alias("_lo"), F.max("brand").alias("_hi")).where("_lo = _hi").select(doc, F.col("_lo").alias("_only"))
    out = rows.join(per, doc, "left").withColumn("brand_changed", F.col("_only").isNotNull() & ~F.col("brand").eqNullSafe(F.col("_only")))
    return out.withColumn("brand", F.coalesce("_only", "brand")).drop("_only")


def table_for_model(table: Column | str, model: Column | str, around: int = 0) -> Column:
    """Lines of a table that name the model, with neighbours, under its first two lines; all lines if none does."""
    lines = F.filter(F.transform(F.split(F.replace(F.coalesce(col(table), F.lit("")), F.lit("\\n"), F.lit("\n")), "\n"), F.trim), lambda x: x != "")
    key = model_name(model)
    hits = F.transform(lines, lambda x: F.contains(model_name(x), key))
    near = lambda i: F.exists(F.slice(hits, F.greatest(i + 1 - around, F.lit(1)), F.least(i + 1 + around, F.size(hits)) - F.greatest(i + 1 - around, F.lit(1)) + 1), lambda h: h)
    kept = F.filter(lines, lambda x, i: (i < 2) | near(i))
    return F.when((key == "") | ~F.exists(hits, lambda h: h), F.array_join(lines, "\n")).otherwise(F.array_join(kept, "\n"))


def role_of(role: Column | str, is_feature: Column | str, is_accessory: Column | str) -> Column:
    """product, series_feature or accessory: the role given, else by the flags."""
    given = F.lower(trimmed(role))
    return F.when(given.isin("product", "series_feature", "accessory"), given).when(F.coalesce(col(is_feature), F.lit(False)), "series_feature").when(F.coalesce(col(is_accessory), F.lit(False)), "accessory").otherwise("product")


def prompt_row(kind: Column | str, content: Column | str, table: Column | str, limit: int = 400) -> Column:
    """A block as short JSON for a prompt: its table if it is one, else its text, cut to ``limit`` characters."""
    cut = lambda c: F.nullif(F.substring(F.coalesce(col(c), F.lit("")), 1, limit), F.lit(""))
    is_table = F.lower(col(kind)) == "table"
    return F.to_json(F.struct(col(kind).alias("type"), F.when(~is_table, cut(content)).alias("content"), F.when(is_table, cut(table)).alias("table_data")))
