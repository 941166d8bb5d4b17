"""The staged extraction: brands, series, models, products, each from the one before.

Every stage is candidates, a merge by key, a review, and a table that the next stage
reads; ``run`` writes each and reuses it unless forced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.text import brand_key, model_name, pair_key, plausible_brand, series_key
from lodestar.operators import knowledge
from lodestar.operators.merge import merge_candidates
from lodestar.provider import Provider, RuleProvider
from lodestar.sources.records import stage


def _mentions(pages: DataFrame, names, extra: list[str] | None = None) -> DataFrame:
    """One row for each name found on a page; evidence is the page's beginning."""
    rows = pages.select("doc", "seq", "page", *(extra or []), F.substring("text", 1, 80).alias("_said"), F.posexplode(names).alias("at", "name"))
    return rows.select("doc", (F.col("seq") * 1000 + F.col("at")).alias("seq"), *(extra or []), "name", F.array("_said").alias("evidence"), F.array(F.col("page").cast("string")).alias("pages"))


def brands(pages: DataFrame, provider: Provider) -> DataFrame:
    found = _mentions(pages, provider.brands(F.col("text")))
    merged = merge_candidates(found, F.concat_ws("|", "doc", brand_key("name")), ["doc"])
    return merged.where(plausible_brand("name")).select("doc", F.col("name").alias("brand"), "evidence", "pages", "seq")


def series(pages: DataFrame, brand_rows: DataFrame, provider: Provider) -> DataFrame:
    """Series on pages that name the brand."""
    own = pages.join(brand_rows.select("doc", "brand", F.explode("pages").alias("page")).withColumn("page", F.col("page").cast(pages.schema["page"].dataType)), ["doc", "page"])
    found = _mentions(own, provider.series(F.col("text")), ["brand"])
    merged = merge_candidates(found, F.concat_ws("|", "doc", "brand", series_key("name")), ["doc", "brand"])
    return merged.select("doc", "brand", F.col("name").alias("series"), "evidence", "pages", "seq")


def models(pages: DataFrame, series_rows: DataFrame, provider: Provider) -> DataFrame:
    """Models on pages that name the series; a model in several series of a brand goes to its best owner."""
    own = pages.join(series_rows.select("doc", "brand", "series", F.explode("pages").alias("page")).withColumn("page", F.col("page").cast(pages.schema["page"].dataType)), ["doc", "page"])
    found = _mentions(own, provider.models(F.col("text")), ["brand", "series"])
    merged = merge_candidates(found, F.concat_ws("|", "doc", "brand", "series", model_name("name")), ["doc", "brand", "series"]).withColumn("model_key", model_name("name"))
    everywhere = merged.groupBy("doc", "model_key").agg(F.array_distinct(F.flatten(F.collect_list("pages"))).alias("global_set"))
    homes = series_rows.select("doc", "brand", "series", F.col("pages").alias("series_set"))
    scored = knowledge.page_overlaps(merged.join(everywhere, ["doc", "model_key"]).join(homes, ["doc", "brand", "series"]).withColumn("local_set", F.col("pages")).withColumn("pair_key", pair_key("brand", "series")))
    owners = knowledge.model_owners(scored.withColumn("brand", F.concat_ws("|", "doc", "brand")))
    return owners.where("rank = 1").select("doc", F.element_at(F.split("brand", r"\|"), -1).alias("brand"), "series", F.col("name").alias("model"), "evidence", "pages", "seq")


def products(pages: DataFrame, model_rows: DataFrame, provider: Provider) -> DataFrame:
    """A product for each model, with the specifications of its pages."""
    own = pages.join(model_rows.select("doc", "brand", "series", "model", F.explode("pages").alias("page")).withColumn("page", F.col("page").cast(pages.schema["page"].dataType)), ["doc", "page"])
    specs = own.select("doc", "brand", "series", "model", "seq", F.posexplode(provider.specs(F.col("text"))).alias("at", "s")).select("doc", "brand", "series", "model", (F.col("seq") * 1000 + F.col("at")).alias("seq"), "s.name", "s.value", "s.unit")
    heads = model_rows.withColumn("manufacturer", F.lit(""))
    keyed = lambda df: df.withColumn("brand", F.concat_ws("|", "doc", "brand"))
    out = knowledge.model_specs(keyed(heads), keyed(specs))
    return out.select(F.element_at(F.split("brand", r"\|"), 1).alias("doc"), F.element_at(F.split("brand", r"\|"), -1).alias("brand"), "series", "model", "manufacturer", "specs")


def run(spark: SparkSession, pages: DataFrame, folder: str, provider: Provider | None = None, force: bool = False) -> dict[str, DataFrame]:
    """All stages; pages: doc, page, seq, text."""
    provider = provider or RuleProvider()
    at = lambda name, compute: stage(spark, f"{folder}/{name}", compute, force)
    b = at("brands", lambda: brands(pages, provider))
    s = at("series", lambda: series(pages, b, provider))
    m = at("models", lambda: models(pages, s, provider))
    p = at("products", lambda: products(pages, m, provider))
    return {"brands": b, "series": s, "models": m, "products": p}
