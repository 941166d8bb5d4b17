"""Merging records that describe one thing: grouped aggregates with explicit tie-breaks.

Order matters in most of these rules, so every input carries a ``seq`` and every
choice is made by (what counts, seq).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.specs import normal_specs
from lodestar.functions.text import Name, as_list, blank, blank_trimmed, col, model_name, trimmed

TEXT_FIELDS = ["brand", "category", "series", "product_model", "manufacturer", "refrigerant", "energy_efficiency_grade"]
LIST_FIELDS = ["features", "key_components", "fact_text", "evidence"]


def ordered_distinct(c: Name, seq: Name = "seq") -> Column:
    """Aggregate: the non-blank entries of the group's arrays, each once, by first appearance."""
    pairs = F.array_sort(F.collect_list(F.struct(col(seq).alias("s"), as_list(c).alias("a"))))
    return F.array_distinct(F.flatten(F.transform(pairs, lambda p: p["a"])))


def longest(c: Name, seq: Name = "seq") -> Column:
    """Aggregate: the longest trimmed text, the first one of equals."""
    return F.coalesce(F.max_by(trimmed(c), F.struct(F.length(trimmed(c)), -col(seq))), F.lit(""))


def first_present(c: Name, seq: Name = "seq") -> Column:
    """Aggregate: the first non-blank text."""
    return F.coalesce(F.min_by(trimmed(c), F.when(~blank_trimmed(c), col(seq))), F.lit(""))


def statistics(entities: DataFrame, batch_col: str = "_batch") -> DataFrame:
    """One row: totals, how many have each field, distinct models, brands and batches (a missing batch counts as 0)."""
    present = lambda c: F.count_if(~blank(c))
    unique = lambda c: F.count_distinct(F.when(~blank(c), col(c)))
    batch = F.coalesce(F.col(batch_col), F.lit(0)) if batch_col in entities.columns else F.lit(0)
    return entities.agg(
        F.count("*").alias("total"),
        present("brand").alias("with_brand"),
        F.count_if(blank("brand")).alias("without_brand"),
        present("product_model").alias("with_model"),
        present("category").alias("with_category"),
        unique("brand").alias("brands"),
        unique("product_model").alias("models"),
        F.count_distinct(batch).alias("batches"),
    )


def success_rate(part: Name, whole: Name) -> Column:
    """``12.5%``, or N/A of nothing."""
    return F.when(F.coalesce(col(whole), F.lit(0)) == 0, "N/A").otherwise(F.format_string("%.1f%%", col(part) * 100.0 / F.nullif(col(whole), F.lit(0))))


def valid_entities(entities: DataFrame, required: list[str] = ["product_model", "category"]) -> DataFrame:  # noqa: B006
    """Rows with any of the required fields; white space counts as a value here."""
    test = F.lit(False)
    for c in required:
        test = test | ~blank(c)
    return entities.where(test)


def valid_products(products: DataFrame) -> DataFrame:
    """Rows with a brand, category, series or model that isn't only white space."""
    test = F.lit(False)
    for c in TEXT_FIELDS[:4]:
        test = test | ~blank_trimmed(c)
    return products.where(test)


def frequency(rows: DataFrame, c: str, seq: str = "seq") -> DataFrame:
    """(value, n, rank) of the non-blank values; rank by count, then by first appearance."""
    counts = rows.where(~blank_trimmed(c)).groupBy(trimmed(c).alias(c)).agg(F.count("*").alias("n"), F.min(seq).alias("first_seq"))
    # one row for each distinct value comes here, after a map-side count
    return counts.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "first_seq")))


def without_rare_brands(entities: DataFrame, ratio: float = 0.01) -> DataFrame:
    """Rows whose brand has at least max(1, floor(total * ratio)) rows; rows without a brand stay."""
    total = entities.agg(F.count("*").alias("total"))
    per = entities.groupBy("brand").agg(F.count("*").alias("brand_rows"))
    least = F.greatest(F.lit(1), F.floor(F.col("total") * F.lit(ratio)))
    rare = per.crossJoin(F.broadcast(total)).where(~blank_trimmed("brand") & (F.col("brand_rows") < least)).select("brand")
    return entities.join(rare, "brand", "left_anti").select(entities.columns)


def frequent_tokens(rows: DataFrame, columns: list[str], pattern: str = r"\b[A-Z]{2,}[0-9]{2,}[A-Z0-9\-]*\b", least: int = 3) -> DataFrame:
    """(token, n) of tokens found at least ``least`` times in the columns' text."""
    text = F.concat_ws(" ", *(F.coalesce(F.col(c), F.lit("")) for c in columns))
    tokens = rows.select(F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def main_values(rows: DataFrame, keys: list[str], c: str, seq: str = "seq") -> DataFrame:
    """The most frequent non-blank value of each key; of equals the one that came first."""
    counts = rows.where(~blank_trimmed(c)).groupBy(*keys, trimmed(c).alias("value")).agg(F.count("*").alias("n"), F.min(seq).alias("first_seq"))
    return counts.groupBy(*keys).agg(F.max_by("value", F.struct(F.col("n"), -F.col("first_seq"))).alias(f"main_{c}"))


def _merged_texts(seq: str) -> list[Column]:
    return [longest(c, seq).alias(c) for c in TEXT_FIELDS] + [ordered_distinct(c, seq).alias(c) for c in LIST_FIELDS]


def _best_specs(rows: DataFrame, key: str, seq: str, order: list[Column]) -> DataFrame:
    """One specification for each (name, value, unit) of a key, chosen by ``order``, in order of first appearance."""
    flat = rows.select(key, F.col(seq).alias("s"), F.posexplode(normal_specs("performance_specs")).alias("at", "spec")).select(key, "s", "at", "spec.*")
    same = Window.partitionBy(key, "name", "value", "unit")
    chosen = flat.withColumns({"rank": F.row_number().over(same.orderBy(*order)), "since": F.min(F.struct("s", "at")).over(same)}).where("rank = 1")
    listed = F.array_sort(F.collect_list(F.struct("since", "name", "value", "unit", "raw")))
    return chosen.groupBy(key).agg(F.transform(listed, lambda x: F.struct(x["name"], x["value"], x["unit"], x["raw"])).alias("performance_specs"))


def merge_by_model(products: DataFrame, seq: str = "seq") -> DataFrame:
    """One row for each model: longest texts, united lists, the specification with the longest raw text of each triple.

    Rows without a model stay apart.  A single row is trimmed like a merged one.
    """
    rows = products.withColumn("merge_key", F.when(blank_trimmed("product_model"), F.concat(F.lit("_no_model_"), F.col(seq).cast("string"))).otherwise(trimmed("product_model")))
    merged = rows.groupBy("merge_key").agg(F.count("*").alias("merged_rows"), F.min(seq).alias(seq), *_merged_texts(seq))
    named = rows.withColumn("performance_specs", F.filter("performance_specs", lambda s: ~blank_trimmed(s["name"]) & ~blank_trimmed(s["raw"])))
    specs = _best_specs(named, "merge_key", seq, [F.length("raw").desc(), F.col("s"), F.col("at")])
    return merged.join(specs, "merge_key", "left").withColumn("performance_specs", F.coalesce("performance_specs", F.array().cast(specs.schema["performance_specs"].dataType)))


def merge_by_canonical_model(products: DataFrame, seq: str = "seq") -> DataFrame:
    """As :func:`merge_by_model`, by the canonical model name; of equal specification triples the first one stays."""
    rows = products.withColumn("product_model", model_name("product_model"))
    rows = rows.withColumn("merge_key", F.when(F.col("product_model") == "", F.concat(F.lit("_no_model_"), F.col(seq).cast("string"))).otherwise(F.col("product_model")))
    merged = rows.groupBy("merge_key").agg(F.count("*").alias("merged_rows"), F.min(seq).alias(seq), *_merged_texts(seq))
    specs = _best_specs(rows, "merge_key", seq, [F.col("s"), F.col("at")])
    return merged.join(specs, "merge_key", "left").withColumn("performance_specs", F.coalesce("performance_specs", F.array().cast(specs.schema["performance_specs"].dataType)))


def single_value_specs(specs: DataFrame, keys: list[str], name_key: str, seq: str = "seq") -> DataFrame:
    """The best entry of each name: with a unit, with a digit, the longest value, the first."""
    order = Window.partitionBy(*keys, name_key).orderBy((F.col("unit") != "").desc(), F.col("value").rlike("[0-9]").desc(), F.length("value").desc(), seq)
    return specs.withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank")


def merge_candidates(candidates: DataFrame, key: Column, parents: list[str], seq: str = "seq") -> DataFrame:
    """Mentions of one key: first name, first non-blank parents, united evidence and pages."""
    return candidates.withColumn("key", key).where("key <> ''").groupBy("key").agg(
        F.min(seq).alias(seq), F.min_by("name", seq).alias("name"), *(first_present(p, seq).alias(p) for p in parents), ordered_distinct("evidence", seq).alias("evidence"), ordered_distinct("pages", seq).alias("pages")
    )
