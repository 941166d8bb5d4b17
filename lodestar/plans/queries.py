"""Registered queries over the driver's tables; each applies library operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.functions.specs import canonical_spec_name, guard_units, parse_line
from lodestar.functions.text import about_series, brand_core, category_of, click_strategy, completeness, edit_similarity, entity_text, format_entity, iso_time, pair_key, product_id, series_hits, whole_seconds
from lodestar.operators import clusters, fusion, hierarchy, imputation, knowledge, matching, merge, quality, retrieval, reviews, windows
from lodestar.operators.components import CHUNK, connected_components
from lodestar.plans.views import entities
from lodestar.provider import RuleProvider
from lodestar.sources import markdown, web
from lodestar.storage import Scratch
from lodestar.streaming import tasks
from lodestar.tables import table


def entity_statistics(spark: SparkSession, sf: str) -> DataFrame:
    e = entities(spark, sf).withColumn("_batch", F.col("seq") % 7)
    return merge.statistics(merge.valid_entities(e))


def brand_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return merge.frequency(entities(spark, sf), "brand")


def rare_brand_filter(spark: SparkSession, sf: str) -> DataFrame:
    return merge.without_rare_brands(entities(spark, sf), 0.038).select("seq", "brand")


def brand_alias_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = fusion.brand_pairs(fusion.brand_table(entities(spark, sf)))
    return pairs.select("brand1", "brand2", F.round(edit_similarity("core1", "core2"), 6).alias("similarity"))


def brand_alias_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = fusion.judge_by_rules(fusion.brand_pairs(fusion.brand_table(entities(spark, sf))))
    return judged.where("method IS NOT NULL").select("brand1", "brand2", "method", "is_alias", "canonical", "confidence")


def _groups(e: DataFrame) -> DataFrame:
    brands = fusion.brand_table(e)
    return fusion.alias_groups(brands, fusion.accepted(fusion.judge_by_rules(fusion.brand_pairs(brands))))


def brand_alias_groups(spark: SparkSession, sf: str) -> DataFrame:
    return _groups(entities(spark, sf))


def brand_alias_applied(spark: SparkSession, sf: str) -> DataFrame:
    e = entities(spark, sf)
    return fusion.apply_aliases(e, _groups(e)).select("seq", "brand", "brand_alias_merged", "original_brand")


def brand_knn_imputation(spark: SparkSession, sf: str) -> DataFrame:
    return imputation.impute_brands(entities(spark, sf)).select("seq", "brand", "brand_inferred", "brand_confidence", "confidence_level")


def brand_representatives(spark: SparkSession, sf: str) -> DataFrame:
    return imputation.representatives(entities(spark, sf)).select("brand", "rank", "seq", "completeness")


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


def vector_label_imputation(spark: SparkSession, sf: str) -> DataFrame:
    v = _vectors(spark, sf)
    asked = v.where("id % 5 = 0").select(F.col("id").alias("query_id"), "vector")
    near = retrieval.nearest(asked, v.where("id % 5 <> 0").select("id", "vector"), 5).join(v.select("id", "label"), "id")
    return imputation.weighted_vote(near, "query_id", "label").select("query_id", F.col("inferred").alias("label"), F.round("confidence", 6).alias("confidence"))


def vector_search(spark: SparkSession, sf: str) -> DataFrame:
    v = _vectors(spark, sf)
    asked = v.where("id % 100 = 0").select(F.col("id").alias("query_id"), "vector")
    return retrieval.search(retrieval.nearest(asked, v.select("id", "vector"), 10), table(spark, sf, "documents").select("doc_id", "text"), 0.25, 100)


def _products(spark: SparkSession, sf: str) -> DataFrame:
    e = entities(spark, sf)
    words = F.split(F.lower("product_model"), "-")
    spec = lambda n, v, u, r: F.struct(F.lit(n).alias("name"), v.alias("value"), F.lit(u).alias("unit"), r.alias("raw"))
    size = F.element_at(words, -1)
    specs = F.array(spec("size", size, "mm", F.concat(F.lit("size: "), size, F.lit("mm"))), spec("kind", F.lower("category"), "", F.concat(F.lit("kind "), F.lower("category"), F.lit(" "), F.col("brand"))))
    return e.withColumns(
        {"refrigerant": F.lit(""), "energy_efficiency_grade": F.lit(""), "features": F.slice(words, 1, 2), "key_components": F.array(F.lower("category")), "fact_text": F.array().cast("array<string>"), "evidence": F.array(F.col("brand")), "performance_specs": specs}
    )


def _merged(rows: DataFrame) -> DataFrame:
    specs = F.array_join(F.transform("performance_specs", lambda s: F.concat_ws("|", s["name"], s["value"], s["unit"], s["raw"])), ";")
    lists = [F.array_join(c, ";").alias(c) for c in ("features", "key_components", "evidence")]
    return rows.select("merge_key", "merged_rows", "seq", "brand", "category", "series", "product_model", *lists, specs.alias("specs"))


def product_dedup_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(merge.merge_by_model(_products(spark, sf)))


def product_dedup_canonical(spark: SparkSession, sf: str) -> DataFrame:
    noisy = F.when(F.col("seq") % 3 == 0, F.concat(F.lit(" "), F.lower("product_model"), F.lit("+ "))).otherwise(F.col("product_model"))
    return _merged(merge.merge_by_canonical_model(_products(spark, sf).withColumn("product_model", noisy)))


def category_correction(spark: SparkSession, sf: str) -> DataFrame:
    e = entities(spark, sf).withColumn("category", F.when(F.col("seq") % 4 == 0, "").otherwise(F.col("category")))
    main = e.withColumn("doc", F.lit(0))
    context = merge.main_values(main, ["doc"], "category").join(merge.main_values(main, ["doc"], "series"), "doc")
    by_word = lambda c: category_of(c, ["bolt", "BOLT", "small"], ["ring", "RING", "large"], ("indoor", "outdoor"))
    fixed = F.coalesce(by_word("product_model"), by_word("series"), F.when(F.col("series") == F.col("main_series"), F.col("main_category")), F.col("category"))
    return main.join(context, "doc").select("seq", fixed.alias("category"), "main_category", "main_series")


def frequent_models(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    rows = part.select(F.concat(F.lit("unit MDV"), F.lpad((F.col("p_partkey") % 50).cast("string"), 3, "0"), F.lit("-S1 and "), F.col("p_name")).alias("content"), F.concat(F.lit("KX"), F.col("p_size").cast("string"), F.lit(" | 5")).alias("table_data"))
    return merge.frequent_tokens(rows, ["content", "table_data"], least=3)


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("page"), "text", "role")


def page_windows(spark: SparkSession, sf: str) -> DataFrame:
    out = windows.context_windows(_pages(spark, sf), "doc", "page", "text", 2)
    return out.select("doc", "page", F.array_join("window_pages", ",").alias("window_pages"), "window_text")


def logical_documents(spark: SparkSession, sf: str) -> DataFrame:
    units = _pages(spark, sf).withColumn("sample", F.col("doc") % 5).withColumn("seq", F.col("doc") * 100 + F.col("page"))
    docs = windows.logical_documents(units, "sample", "seq", "page")
    return windows.logical_pages(docs, ["sample", "logical_doc"], "seq", "page").select("sample", "seq", "logical_doc", "logical_page")


def page_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return windows.fixed_clusters(_pages(spark, sf), "doc", "page", "text", 3).select("doc", "cluster", F.array_join("pages", ",").alias("pages"), "text")


def keyword_retrieval(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), "text")
    return retrieval.by_keywords(docs, "text", ["Tion", "licensed", "einheit", "tion", "mit"], 2, top=25).select("seq", "hits")


def follow_pages(spark: SparkSession, sf: str) -> DataFrame:
    return windows.following_pages(_pages(spark, sf), "doc", "page", F.col("page") % 5 == 0, 2).select("doc", "page")


def name_occurrences(spark: SparkSession, sf: str) -> DataFrame:
    return matching.occurrence_pairs_of_texts(table(spark, sf, "benchmark"), table(spark, sf, "documents"), "item_id", "doc_id", "text")


def series_occurrences(spark: SparkSession, sf: str) -> DataFrame:
    """Series of parts, nations and the beginnings of benchmark items as names, and the documents that they are in."""
    names = entities(spark, sf).select(F.col("series").alias("name")).unionByName(table(spark, sf, "nation").select(F.col("n_name").alias("name")))
    names = names.unionByName(table(spark, sf, "benchmark").select(F.array_join(F.slice(F.split("text", " "), 1, 4), " ").alias("name")))
    return matching.occurrence_pairs(names, table(spark, sf, "documents"), "name", "doc_id", "text")


def bind_known_models(spark: SparkSession, sf: str) -> DataFrame:
    e = entities(spark, sf)
    known = e.where("seq % 3 = 0").select("category", F.concat_ws("-", F.slice(F.split("product_model", "-"), 1, 2)).alias("model"))
    known = known.unionByName(e.where("seq % 5 = 0").select("category", F.col("product_model").alias("model")))
    bound = matching.bind_to_known_models(e.select("seq", "category", "product_model"), known, ["category"])
    return bound.select("seq", "known_model")


def model_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    item = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_quantity", "l_linenumber")
    per = item.groupBy("l_partkey", "l_suppkey").agg(F.count_distinct("l_orderkey").alias("local_pages"), F.count("*").alias("evidence_count"), F.max("l_linenumber").alias("series_hits"))
    series = item.groupBy("l_suppkey").agg((F.count_distinct("l_linenumber")).alias("series_pages"))
    rows = per.join(series, "l_suppkey").select(
        F.lit("all").alias("brand"), F.col("l_partkey").cast("string").alias("model_key"), pair_key(F.lit("all"), F.col("l_suppkey").cast("string")).alias("pair_key"),
        F.least("local_pages", F.lit(2)).alias("overlap_global"), F.least("local_pages", F.lit(1)).alias("overlap_local"), "series_hits", "local_pages", "evidence_count", "series_pages",
    )
    return knowledge.model_owners(rows).where("rank = 1 AND rivals > 1").select("model_key", F.col("pair_key").alias("winner"), "rivals", "local_pages")


def model_spec_relations(spark: SparkSession, sf: str) -> DataFrame:
    e = entities(spark, sf).withColumn("model", F.col("series"))
    specs = e.select("brand", "series", "model", "seq", F.lit("kind").alias("name"), F.col("category").alias("value"), F.lit("").alias("unit"))
    out = knowledge.model_specs(e, specs)
    return out.select("brand", "series", "model", "manufacturer", "records", F.array_join(F.transform("specs", lambda s: s["value"]), ";").alias("specs"))


def _records(spark: SparkSession, sf: str) -> DataFrame:
    supplier = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    makers = supplier.select(F.col("s_suppkey"), F.col("s_name"), F.col("n_name"))
    total = makers.agg(F.max("s_suppkey").alias("top"))
    e = entities(spark, sf).crossJoin(F.broadcast(total))
    return e.join(makers, F.pmod("seq", F.col("top") + 1) == F.col("s_suppkey"), "left").select("seq", "brand", "product_model", F.coalesce("s_name", F.lit("")).alias("manufacturer"), "series", F.coalesce("n_name", F.lit("")).alias("category"))


def graph_nodes(spark: SparkSession, sf: str) -> DataFrame:
    records = _records(spark, sf)
    nodes = knowledge.product_nodes(records, ["series", "category"]).select(F.lit("Product").alias("label"), F.col("product_id").alias("key"), "series", "category")
    return nodes.unionByName(knowledge.dimension_nodes(records), allowMissingColumns=True)


def graph_edges(spark: SparkSession, sf: str) -> DataFrame:
    return knowledge.edges(_records(spark, sf))


def batch_envelope(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("batch"))
    items = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("batch"), F.col("l_linenumber").alias("seq"), F.col("l_partkey").alias("part"), F.col("l_quantity").cast("int").alias("quantity"))
    out = knowledge.batch_envelopes(orders, items, "batch", ["part", "quantity"])
    return out.select("batch", F.size("results").alias("n"), F.array_join(F.transform("results", lambda r: F.concat(r["part"].cast("string"), F.lit(":"), r["quantity"].cast("string"))), ";").alias("results"))


def crawl_url_dedup(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("seq"), F.split_part("url", F.lit("?"), F.lit(1)).alias("url"))
    again = pages.where("seq % 3 = 0").withColumn("seq", F.col("seq") + 1000000)
    return matching.new_urls(pages.unionByName(again), pages.where("seq % 7 = 0"))


def crawl_listing(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    return retrieval.listing(pages, [F.desc("url"), F.asc("page_id")], 20, 30, contains=("url", "example.com"))


def page_content_extract(spark: SparkSession, sf: str) -> DataFrame:
    return web.page_content(table(spark, sf, "pages"))


def page_links(spark: SparkSession, sf: str) -> DataFrame:
    return web.page_links(table(spark, sf, "pages"))


def task_latest_status(spark: SparkSession, sf: str) -> DataFrame:
    return tasks.latest(table(spark, sf, "events"), "user_id", "ts").select("user_id", "event_id", "event_type", "value")


def incremental_index(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"), F.col("source").alias("title"), "text")
    old = retrieval.index_entries(docs.where("id % 4 <> 0"))
    return retrieval.upsert_missing(old, retrieval.index_entries(retrieval.index_increment(docs, 99)))


def overflow_report(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    calls = table(spark, sf, "events").select(F.concat("event_type", F.lit("_schema")).alias("schema"), F.concat(F.lit("host"), (F.col("user_id") % 3).cast("string")).alias("host"), (k * 100).alias("prompt_tokens"), F.when(k % 2 == 0, k * 10).alias("completion_tokens"))
    out = quality.overflow_report(calls, {"prompt_tokens": 4000, "completion_tokens": 300})
    return out.withColumn("hosts", F.array_join("hosts", ","))


def batch_summary(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    done = events.select(F.concat(F.lit("b"), (F.col("user_id") % 20).cast("string")).alias("brand"), F.col("value").cast("int").alias("products"), F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped").otherwise("completed").alias("status"))
    return quality.batch_summary(done)


def spec_parse(spark: SparkSession, sf: str) -> DataFrame:
    e = entities(spark, sf)
    n = F.element_at(F.split("product_model", "-"), -1)
    line = F.when(F.col("seq") % 3 == 0, F.concat(F.lit("size: "), n, F.lit("mm"))).when(F.col("seq") % 3 == 1, F.concat(F.lit("Power (kW) = "), n, F.lit(".5"))).otherwise(F.concat(F.lit("weight "), n, F.lit(" kg")))
    rows = e.select("seq", guard_units(F.array_compact(F.array(parse_line(line))), {"size": "mm"}).alias("specs"))
    return rows.select("seq", F.explode("specs").alias("s")).select("seq", "s.name", "s.value", "s.unit", "s.raw")


def connected_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Components of customers, each linked with the one before: long chains, the worst case of contraction."""
    chain = table(spark, sf, "customer").select(F.col("c_custkey").alias("src"), (F.col("c_custkey") - 1).alias("dst"))
    return connected_components(chain, chunk=CHUNK)


def text_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return markdown.chunks(table(spark, sf, "documents"), "doc_id", "text", 2000)


def prompt_batches(spark: SparkSession, sf: str) -> DataFrame:
    return windows.prompt_batches(_pages(spark, sf), "doc", "page", "text", 3, 900)


def alias_clusters(spark: SparkSession, sf: str) -> DataFrame:
    brands = fusion.brand_table(entities(spark, sf)).withColumn("doc", F.lit(0))
    vectors = RuleProvider().embed(F.regexp_replace("core", "(.)", "$1 "))
    return clusters.semantic_groups(brands.select("doc", F.col("brand").alias("name"), F.col("freq").alias("n_pages"), vectors.alias("vector")), 0.1)


def containment_groups(spark: SparkSession, sf: str) -> DataFrame:
    brands = entities(spark, sf).where("brand <> ''").groupBy("brand").agg(F.min("seq").alias("seq"))
    rows = brands.select(F.lit(0).alias("doc"), "seq", F.col("brand").alias("name"), brand_core("brand").alias("key"), F.array(F.col("seq").cast("string")).alias("pages"))
    return clusters.containment_groups(rows)


def markdown_pages(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("file"), F.posexplode(F.split("text", "\n")).alias("order", "text")).withColumn("target", F.lit(3))
    return markdown.pages(rows, "target")


def stream_dedup_index(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a stream of deliveries: the first sighting of each user, kept once, in a table."""
    scratch = Scratch(spark, "stream")
    source, sink, mark = (scratch.path(x) for x in ("source", "sink", "mark"))
    events = table(spark, sf, "events").select("user_id")
    events.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)
    tasks.run_available(stream, tasks.keep_new(sink, "user_id"), mark)
    return spark.read.parquet(sink).select("user_id")


def page_order(spark: SparkSession, sf: str) -> DataFrame:
    """Page labels of both forms in their natural order within each document."""
    label = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("part_10_20_d"), F.col("conv_id").cast("string"), F.lit("_page_"), F.col("turn").cast("string"))).otherwise(F.concat(F.lit("d"), F.col("conv_id").cast("string"), F.lit("_page_"), F.col("turn").cast("string")))
    rows = table(spark, sf, "conversations").select(label.alias("label")).withColumn("k", windows.page_sort_key("label"))
    return rows.select("label", F.col("k.doc").alias("doc"), F.row_number().over(Window.partitionBy("k.doc").orderBy("k.at", "k.label")).alias("rank"))


def series_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Series names in several spellings, sifted and merged by key."""
    e = entities(spark, sf)
    ending = F.when(F.col("seq") % 3 == 0, "系列").when(F.col("seq") % 3 == 1, "系列室内机").otherwise("系列 1) 说明")
    rows = e.select("category", "seq", F.concat(F.upper("series"), ending).alias("name"), F.array("brand").alias("evidence"), F.array((F.col("seq") % 5).cast("string")).alias("pages"))
    out = reviews.merge_series(rows, ["category"])
    return out.select("category", "series_key", "name", F.size("evidence").alias("n_evidence"), F.array_join("pages", ",").alias("pages"))


def model_redirects(spark: SparkSession, sf: str) -> DataFrame:
    """Models after a review that drops some and moves others to a series it is sure of."""
    e = entities(spark, sf).where("brand <> ''")
    models = e.groupBy("brand", "series", F.col("product_model").alias("name")).agg(F.min("seq").alias("seq"))
    verdicts = models.where("seq % 4 <> 0").select(
        "brand", "series", "name", (F.col("seq") % 4 != 1).alias("keep"), F.lit("model").alias("kind"), F.when(F.col("seq") % 4 == 2, "RED").alias("series_guess"), F.lit("").alias("redirect_to"), F.when(F.col("seq") % 3 == 0, 0.5).otherwise(0.9).alias("confidence")
    )
    return reviews.redirect_models(models, verdicts, e.select("brand", "series").distinct()).select("brand", "series", "name", "redirected")


def series_feature_merge(spark: SparkSession, sf: str) -> DataFrame:
    """What is said of a series, given to each of its products."""
    p = _products(spark, sf)
    said = p.where("seq % 11 = 0").select("brand", "series", "seq", F.array(F.concat(F.lit("fit for "), F.lower("category"))).alias("features"), F.array(F.col("product_model")).alias("fact_text"), F.array(F.lit("fan")).alias("key_components"))
    out = reviews.add_series_features(p, said)
    return out.select("seq", F.array_join("features", ";").alias("features"), F.array_join("key_components", ";").alias("key_components"), F.size("fact_text").alias("n_facts"))


def completeness_scores(spark: SparkSession, sf: str) -> DataFrame:
    e = entities(spark, sf)
    fields = {c: c for c in ("brand", "category", "series", "product_model", "manufacturer")}
    return e.select("seq", completeness(fields, [F.array("brand")]).alias("score"), product_id("brand", "series", "category", "product_model", F.lit("record")).alias("product_id"))


def single_brand_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of documents that know only one brand get it."""
    e = entities(spark, sf).select("seq", F.floor(F.col("seq") / 3).cast("long").alias("doc"), F.when(F.col("seq") % 3 == 1, F.col("brand")).when(F.col("seq") % 7 == 0, F.col("brand")).otherwise("").alias("brand"))
    return reviews.single_brand_scope(e).select("seq", "brand", "brand_changed")


def call_limits(spark: SparkSession, sf: str) -> DataFrame:
    """Limits that the overflow report asks for."""
    return quality.recommended_limits(overflow_report(spark, sf), text_schemas=["click_schema", "view_schema"])


def stored_urls(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", F.split_part("url", F.lit("?"), F.lit(1)).alias("url"))
    return matching.known_urls(pages, pages.where("page_id % 7 = 0")).select("page_id", "url")


def dropped_brands(spark: SparkSession, sf: str) -> DataFrame:
    """Brands of a snapshot that neither stay nor are an alias of one that does."""
    e = entities(spark, sf).where("brand <> ''")
    before = e.groupBy(F.col("brand").alias("name")).agg(F.min("seq").alias("seq"))
    after = before.where("length(name) < 8").select(F.lower("name").alias("name"), F.array(F.concat("name", F.lit("0"))).alias("aliases"))
    return matching.dropped_names(before, after).select("name", "reason")


#: Names of specifications and raw texts in all forms that the rules know.
SPEC_EXAMPLES = [
    ("Rated Cooling Capacity", ""), ("AirFlow (H/M/L)", ""), ("standard static-pressure", ""), ("Gas pipe diameter", ""), ("APF rating", ""), ("Power", ""), ("input_power", ""), ("Power colour", "风量 1200m3/h"),
    ("机外静压 范围", ""), ("外机静压", ""), ("风量(H/M/L)", ""), ("尺寸 W×D×H", ""), ("噪音_High", ""), ("", "净重：12kg"), ("", "运行电流 5A"), ("", "产品说明 3"), (" colour ;", "blue"), ("接口 10x20", ""),
]


def spec_names(spark: SparkSession, sf: str) -> DataFrame:
    """Specifications of parts under their canonical names."""
    known = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(r).alias("raw")) for n, r in SPEC_EXAMPLES))
    rows = entities(spark, sf).select("seq", F.get(known, (F.col("seq") % len(SPEC_EXAMPLES)).cast("int")).alias("s"))
    return rows.select("seq", canonical_spec_name("s.name", "s.raw").alias("name"))


def _mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Brands and series of parts as candidates found on pages of documents."""
    e = entities(spark, sf).where("brand <> ''")
    page = (F.col("seq") % 7).cast("string")
    return e.select((F.col("seq") % 11).alias("doc"), "seq", F.col("brand"), "series", F.col("product_model").alias("model"), F.array("category").alias("evidence"), F.array(page).alias("pages"))


def brand_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    shown = F.when(F.col("seq") % 2 == 0, F.upper("brand")).otherwise(F.concat(F.lit(" "), F.col("brand")))
    out = hierarchy.brand_snapshot(_mentions(spark, sf).withColumn("name", shown))
    return out.select("doc", "brand_key", "name", F.array_join("evidence", ",").alias("evidence"), F.array_join("pages", ",").alias("pages"), "rank")


def primary_brands(spark: SparkSession, sf: str) -> DataFrame:
    """One brand a document: the first chosen one of its snapshot, or the first of all."""
    rows = _mentions(spark, sf)
    snapshot = hierarchy.brand_snapshot(rows.withColumn("name", F.col("brand")))
    chosen = rows.where("doc % 2 = 0 AND seq % 3 = 0").select("doc", F.lower("brand").alias("name"))
    return hierarchy.primary_brand(snapshot, chosen).select("doc", "name", "chosen")


def model_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """Models by document, brand and series, keyed and merged; documents of one brand put all under it."""
    rows = _mentions(spark, sf).withColumn("name", F.concat(F.lower("model"), F.lit(" ")))
    rows = rows.withColumn("doc", F.floor(F.col("seq") / 2).cast("long"))
    brands = rows.where("seq % 2 = 1").select("doc", F.col("brand").alias("name"))
    out = hierarchy.single_brand_models(brands, rows)
    return out.select("doc", "pair_key", "name", "model_key", F.array_join("pages", ",").alias("pages"), "changed")


def chunk_series(spark: SparkSession, sf: str) -> DataFrame:
    """Series named by several chunks of a document, each once, with the pages of their chunks where they have none."""
    rows = _mentions(spark, sf).withColumns({"name": F.when(F.col("seq") % 2 == 0, F.upper("series")).otherwise(F.col("series")), "chunk_pages": F.col("pages")})
    rows = rows.withColumn("pages", F.when(F.col("doc") % 2 == 0, F.col("pages")).otherwise(F.array().cast("array<string>")))
    return hierarchy.merge_chunk_series(rows).select("doc", "brand", "name", F.array_join("evidence", ",").alias("evidence"), F.array_join("pages", ",").alias("pages"))


def product_defaults(spark: SparkSession, sf: str) -> DataFrame:
    rows = entities(spark, sf).select("seq", F.when(F.col("seq") % 3 > 0, F.concat("brand", F.lit(" "))).alias("brand"), F.when(F.col("seq") % 4 > 0, F.col("category")).alias("category"), F.lower("product_model").alias("product_model"), F.when(F.col("seq") % 2 == 0, F.array("series")).alias("evidence"))
    out = hierarchy.product_defaults(rows.withColumns({"found_brand": F.lit("Found"), "found_series": F.lit("S"), "read": F.array((F.col("seq") % 5).cast("string"))}), "found_brand", "found_series", "read")
    return out.select("seq", "brand", "category", "series", "product_model", "manufacturer", F.array_join("evidence", ",").alias("evidence"), F.size("features").alias("n_features"))


def settled_brands(spark: SparkSession, sf: str) -> DataFrame:
    """Votes of vectors' labels and a model's answers, of which only known labels count."""
    v = _vectors(spark, sf)
    voted = v.select(F.col("id").alias("row_id"), F.when(F.col("id") % 5 > 0, F.col("label").cast("string")).alias("inferred"), F.lit(0.5).alias("confidence"))
    answers = v.where("id % 2 = 0").select(F.col("id").alias("row_id"), F.concat((F.col("label") + F.col("id") % 3).cast("string"), F.when(F.col("id") % 4 == 0, "x").otherwise(" ")).alias("brand"), F.lit(0.9).alias("confidence"))
    return hierarchy.settled_brands(voted, answers, v.select(F.col("label").cast("string").alias("brand")).distinct())


def corrected_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Categories of parts by label, by words, and by what their document is mostly about."""
    e = entities(spark, sf).withColumns({"doc": F.col("seq") % 13, "category": F.when(F.col("seq") % 4 == 0, "").otherwise(F.col("category"))})
    by_word = lambda c: category_of(c, ["bolt", "BOLT", "small"], ["ring", "RING", "large"], ("indoor", "outdoor"))
    by_label = lambda c: F.when(F.col(c).endswith("-7"), "labelled")
    return hierarchy.corrected_categories(e, "doc", by_word, by_label).select("seq", "category")


def _crawls(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), F.concat(F.lit("u"), (F.col("user_id") % 20).cast("string")).alias("original_url"), F.col("ts").alias("crawled_at"))


def latest_crawls(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.latest_crawls(_crawls(spark, sf), "u7", 25).select("id", "original_url")


def task_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The newest tasks of one type, with their times as text and how long before the type's last one they came."""
    tasks_ = table(spark, sf, "events").select(F.col("event_id").alias("task_id"), F.col("event_type").alias("type"), F.col("ts").alias("created_at"))
    last = tasks_.where("type = 'view'").agg(F.max("created_at").alias("last"))
    return retrieval.task_list(tasks_, "view", 40).crossJoin(F.broadcast(last)).select("task_id", iso_time("created_at").alias("created"), whole_seconds("created_at", "last").alias("seconds_before"))


def entity_texts(spark: SparkSession, sf: str) -> DataFrame:
    e = entities(spark, sf)
    words = e.withColumn("words", F.split("product_model", "-"))
    return words.select("seq", entity_text().alias("text"), format_entity(lists=["words"], most=2).alias("shown"), about_series("series").alias("is_series"))


def evidence_hits(spark: SparkSession, sf: str) -> DataFrame:
    """In how many of its texts a part's series is named."""
    e = entities(spark, sf)
    return e.select("seq", series_hits(F.concat("series", F.lit("系列")), F.array("product_model", "category", F.concat(F.lit("the "), F.upper("series"), F.lit(" one")), "brand")).alias("hits"))


def page_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    """The scores of parts' suppliers from the sets of their orders' line numbers."""
    item = table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.collect_set("l_linenumber").alias("local_set"), F.collect_set((F.col("l_quantity").cast("int") % 7).cast("int")).alias("series_set"))
    item = item.withColumns({"global_set": F.array(F.lit(1), F.lit(2), F.lit(3)), "series": F.concat(F.lit("S"), F.col("l_suppkey").cast("string")), "evidence": F.array(F.concat(F.lit("of s"), F.col("l_suppkey").cast("string")), F.lit("none"))})
    item = item.withColumn("local_set", F.transform("local_set", lambda x: x.cast("int")))
    return knowledge.page_overlaps(item).select("l_partkey", "l_suppkey", "overlap_global", "overlap_local", "series_hits", "local_pages", "evidence_count", "series_pages")


def resolved_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links of every form against pages' addresses."""
    forms = ["../up/./x", "/a/../b", "y?q=1", "?only=1", "#part", "//host.example/z", "mailto:a@b.cd", "", "../../../../top", "d/.."]
    pages = table(spark, sf, "pages").select("page_id", F.lit("http://site.example/p/q/r?x=1").alias("base"), F.explode(F.array(*map(F.lit, forms))).alias("href"))
    return pages.select("page_id", "href", web.resolve(F.col("base"), F.col("href")).alias("url"), click_strategy("href", F.lit("article-card")).alias("strategy"))


QUERIES = {
    f.__name__: f
    for f in (
        entity_statistics, brand_frequency, rare_brand_filter, brand_alias_pairs, brand_alias_rules, brand_alias_groups, brand_alias_applied, brand_knn_imputation, brand_representatives,
        vector_label_imputation, vector_search, product_dedup_merge, product_dedup_canonical, category_correction, frequent_models, page_windows, logical_documents, page_clusters, keyword_retrieval,
        follow_pages, name_occurrences, series_occurrences, bind_known_models, model_conflicts, model_spec_relations, graph_nodes, graph_edges, batch_envelope, crawl_url_dedup, crawl_listing, page_content_extract,
        page_links, task_latest_status, incremental_index, overflow_report, batch_summary, spec_parse, connected_parts, text_chunks, prompt_batches, alias_clusters, containment_groups, markdown_pages,
        stream_dedup_index, page_order, series_merge, model_redirects, series_feature_merge, completeness_scores, single_brand_documents, call_limits, stored_urls, dropped_brands,
        spec_names, brand_snapshot, primary_brands, model_hierarchy, chunk_series, product_defaults, settled_brands, corrected_categories, latest_crawls, task_listing, entity_texts, evidence_hits,
        page_overlaps, resolved_links,
    )
}
