"""From product records to a graph: owners of contested models, relation tables, nodes and edges, envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.text import blank_trimmed, product_id, trimmed
from lodestar.operators.merge import first_present, ordered_distinct

#: The scores that decide who owns a model, the weightiest first.
OWNER_SCORES = ["overlap_global", "overlap_local", "series_hits", "local_pages", "evidence_count", "series_pages"]


def model_owners(candidates: DataFrame) -> DataFrame:
    """Adds ``rank`` (1: the owner) and ``rivals`` to candidates of (brand, model_key) with the six scores and pair_key.

    Scores compare one after the other; of equal candidates the larger pair key wins.
    """
    order = Window.partitionBy("brand", "model_key").orderBy(*(F.desc(c) for c in [*OWNER_SCORES, "pair_key"]))
    whole = Window.partitionBy("brand", "model_key")
    return candidates.withColumn("rank", F.row_number().over(order)).withColumn("rivals", F.count("*").over(whole))


def page_overlaps(candidates: DataFrame) -> DataFrame:
    """The six scores from the page sets local_set, global_set, series_set and the evidence."""
    shared = lambda a, b: F.size(F.array_intersect(a, b))
    hits = F.size(F.filter("evidence", lambda e: (F.length("series") >= 2) & F.contains(F.lower(e), F.lower(F.col("series")))))
    return candidates.withColumns(
        {
            "overlap_global": shared("global_set", "series_set"),
            "overlap_local": shared("local_set", "series_set"),
            "series_hits": hits,
            "local_pages": F.size("local_set"),
            "evidence_count": F.size("evidence"),
            "series_pages": F.size("series_set"),
        }
    )


def brand_series_edges(series: DataFrame) -> DataFrame:
    return series.where(~blank_trimmed("brand") & ~blank_trimmed("series")).groupBy("brand", "series").agg(ordered_distinct("pages").alias("pages"), ordered_distinct("evidence").alias("evidence"))


def series_model_edges(models: DataFrame) -> DataFrame:
    return models.where(~blank_trimmed("model")).groupBy("brand", "series", "model").agg(ordered_distinct("pages").alias("pages"), ordered_distinct("evidence").alias("evidence"))


def model_specs(products: DataFrame, specs: DataFrame, seq: str = "seq") -> DataFrame:
    """One row for each (brand, series, model): first manufacturer, and its specification triples, each once, in order.

    ``specs`` has the same keys, ``seq`` and name, value, unit.
    """
    keys = ["brand", "series", "model"]
    heads = products.groupBy(*keys).agg(first_present("manufacturer", seq).alias("manufacturer"), F.count("*").alias("records"))
    once = specs.groupBy(*keys, "name", "value", "unit").agg(F.min(seq).alias("s"))
    listed = once.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("s", "name", "value", "unit"))).alias("x"))
    return heads.join(listed, keys, "left").select(*keys, "manufacturer", "records", F.coalesce(F.transform("x", lambda t: F.struct(t["name"], t["value"], t["unit"])), F.array().cast("array<struct<name:string,value:string,unit:string>>")).alias("specs"))


def product_nodes(records: DataFrame, props: list[str], seq: str = "seq") -> DataFrame:
    """Upserted product nodes: of each property the last value that isn't null."""
    keyed = records.withColumn("product_id", product_id("brand", "series", "category", "product_model", F.concat(F.lit("record_"), F.col(seq).cast("string"))))
    return keyed.groupBy("product_id").agg(*(F.max_by(p, F.when(F.col(p).isNotNull(), F.col(seq))).alias(p) for p in props))


_RELATIONS = [("brand", "BRANDED_BY"), ("manufacturer", "MANUFACTURED_BY"), ("category", "IN_CATEGORY"), ("series", "IN_SERIES")]


def dimension_nodes(records: DataFrame) -> DataFrame:
    """(label, key): the distinct names of each kind, in one pass over the records."""
    pairs = F.array(*(F.struct(F.lit(c.capitalize()).alias("label"), trimmed(c).alias("key")) for c, _ in _RELATIONS))
    return records.select(F.explode(pairs).alias("n")).select("n.*").where("key <> ''").distinct()


def edges(records: DataFrame, seq: str = "seq") -> DataFrame:
    """(src, rel, dst), each once, in one pass over the records."""
    source = product_id("brand", "series", "category", "product_model", F.concat(F.lit("record_"), F.col(seq).cast("string")))
    pairs = F.array(*(F.struct(F.lit(rel).alias("rel"), trimmed(c).alias("dst")) for c, rel in _RELATIONS))
    return records.select(source.alias("src"), F.explode(pairs).alias("e")).select("src", "e.*").where("dst <> ''").distinct()


def broken_keys(nodes: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once; none should."""
    return nodes.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def batch_envelopes(batches: DataFrame, results: DataFrame, batch: str, fields: list[str], seq: str = "seq") -> DataFrame:
    """(batch, results): the records of every batch in order, an empty list for a batch without any.

    The batch of a merged record is the smallest of those it was merged from.
    """
    main = F.coalesce(F.array_min("_merged_from_batches"), F.col(batch), F.lit(0)) if "_merged_from_batches" in results.columns else F.coalesce(F.col(batch), F.lit(0))
    rows = results.select(main.alias(batch), F.struct(F.col(seq).alias("_seq"), *fields).alias("r"))
    grouped = rows.groupBy(batch).agg(F.transform(F.array_sort(F.collect_list("r")), lambda r: F.struct(*(r[f].alias(f) for f in fields))).alias("results"))
    out = batches.select(batch).distinct().join(grouped, batch, "left")
    return out.withColumn("results", F.coalesce("results", F.array().cast(grouped.schema["results"].dataType)))


def explode_envelopes(envelopes: DataFrame, order: str) -> DataFrame:
    """Records of envelopes with the ordinals of both levels."""
    numbered = envelopes.withColumn("_batch", F.row_number().over(Window.orderBy(order)) - 1)  # one row for each envelope
    return numbered.select("_batch", F.posexplode("results").alias("result_index", "r")).select("_batch", "result_index", "r.*")
