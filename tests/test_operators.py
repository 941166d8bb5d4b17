import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestar.functions.specs import guard_units, parse_line, spec_name, split_lines
from lodestar.operators import clusters, fusion, imputation, knowledge, matching, merge, quality, retrieval, windows
from lodestar.operators.components import connected_components
from lodestar.plans.views import entities
from lodestar.sources.records import PRODUCT

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("seed, chunk", [(0, 1000), (1, 7), (2, 20), (3, 1)])
def test_components_against_union_find(spark, seed, chunk):
    r = random.Random(seed)
    n = 60
    pairs = [(r.randrange(n), r.randrange(n)) for _ in range(r.choice([0, 5, 40, 120]))] + [(k, k + 1) for k in range(100, 130)] + [(7, None), (3, 3)]
    parent = list(range(200))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    touched = {x for a, b in pairs if b is not None and a != b for x in (a, b)}
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "src long, dst long"), chunk=chunk).collect()}
    assert got == {x: min(y for y in touched if find(y) == find(x)) for x in touched}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).collect() == []


def product(**fields):
    base = dict.fromkeys([f.name for f in PRODUCT.fields], None)
    return base | fields


def test_merge_by_model(spark):
    spec = lambda n, v, u, r: (n, v, u, r)
    rows = [
        product(product_model="M1", brand="A", features=["x", "y"], key_components=["c"], performance_specs=[spec("Power", "1", "kW", "Power 1"), spec("", "1", "", "z")]),
        product(product_model=" M1 ", brand="AB", features=["y", "z"], key_components=["d"], performance_specs=[spec("Power", "1", "kW", "Power: 1 kW"), spec("Voltage", "220", "V", "220V")]),
        product(product_model="", brand="N"),
        product(product_model=None, brand="N"),
    ]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], PRODUCT).withColumn("seq", F.monotonically_increasing_id())
    df = spark.createDataFrame([(*r, i) for i, r in enumerate([tuple(x.values()) for x in rows])], "struct<" + PRODUCT.simpleString()[7:-1] + ",seq:bigint>")
    out = {r.merge_key: r for r in merge.merge_by_model(df).collect()}
    assert set(out) == {"M1", "_no_model_2", "_no_model_3"}
    m = out["M1"]
    assert (m.brand, m.features, m.key_components, m.merged_rows) == ("AB", ["x", "y", "z"], ["c", "d"], 2)
    assert [(s.name, s.raw) for s in m.performance_specs] == [("Power", "Power: 1 kW"), ("Voltage", "220V")]


def test_rare_brands_and_statistics(spark):
    rows = [(i, "big", "m", "c") for i in range(98)] + [(98, "rare", "m", ""), (99, "", " ", None)]
    df = spark.createDataFrame(rows, "seq long, brand string, product_model string, category string")
    kept = {r.seq for r in merge.without_rare_brands(df, 0.02).collect()}
    assert kept == set(range(98)) | {99}
    s = merge.statistics(df).first()
    assert (s.total, s.with_brand, s.without_brand, s.with_model, s.with_category, s.batches) == (100, 99, 1, 100, 98, 1)
    assert merge.valid_entities(df).count() == 100


def test_frequency_ties_by_first_appearance(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "a"), (3, "b"), (4, " "), (5, None)], "seq long, v string")
    assert [(r.v, r["rank"]) for r in merge.frequency(df, "v").orderBy("rank").collect()] == [("b", 1), ("a", 2)]
    main = merge.main_values(df.withColumn("doc", F.lit(1)), ["doc"], "v").first()
    assert main.main_v == "b"


def test_alias_rules_and_groups(spark):
    rows = [(i, b) for i, b in enumerate(["Midea"] * 30 + ["midea"] * 25 + ["Midea Co"] * 22 + ["Gree"] * 21)]
    df = spark.createDataFrame(rows, "seq long, brand string")
    brands = fusion.brand_table(df)
    judged = fusion.judge_by_rules(fusion.brand_pairs(brands))
    methods = {(r.brand1, r.brand2): r.method for r in judged.collect()}
    assert methods["Midea", "midea"] == "rule_exact_match"
    assert methods["Midea", "Midea Co"] == "rule_contains"
    groups = {r.brand: r.canonical for r in fusion.alias_groups(brands, fusion.accepted(judged)).collect()}
    assert groups == {"Midea": "Midea", "midea": "Midea", "Midea Co": "Midea", "Gree": "Gree"}
    out = fusion.apply_aliases(df, fusion.alias_groups(brands, fusion.accepted(judged)))
    assert out.where("brand_alias_merged").count() == 47 and out.count() == 98


def test_imputation_edges(spark):
    rows = [(0, "", "AB-1", "mk", "s", "c"), (1, None, "", "mk", "s", "c"), (2, "X", "AB-1", "mk", "s", "c"), (3, "Y", "ZZ-9", "mk", "t", "c")]
    df = spark.createDataFrame(rows, "seq long, brand string, product_model string, manufacturer string, series string, category string")
    got = {r.seq: (r.brand, r.brand_inferred, r.confidence_level) for r in imputation.impute_brands(df).collect()}
    assert got[0] == ("X", True, got[0][2])
    assert got[1] == ("UNKNOWN", False, "failed")  # without a model nothing is similar
    assert got[2] == ("X", False, None)


def test_no_python_in_declarative_plans(spark):
    plan = imputation.impute_brands(entities(spark, DATA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    plan = imputation.representatives(entities(spark, DATA))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_logical_documents(spark):
    df = spark.createDataFrame([(0, i, p) for i, p in enumerate([0, 1, 2, 0, 0, 1])], "g int, seq int, page_idx int")
    out = windows.logical_pages(windows.logical_documents(df, "g", "seq", "page_idx"), ["g", "logical_doc"], "seq", "page_idx").orderBy("seq").collect()
    assert [(r.logical_doc, r.logical_page) for r in out] == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 0), (1, 1)]


def test_page_sort_key(spark):
    labels = ["x_page_10", "x_page_2", "part_5_9_x_page_1", "odd", None]
    out = spark.createDataFrame([(v,) for v in labels], "a string").orderBy(windows.page_sort_key("a")).collect()
    assert [r.a for r in out] == [None, "odd", "x_page_2", "part_5_9_x_page_1", "x_page_10"]


def test_prompt_batches(spark):
    df = spark.createDataFrame([(1, i, "x" * n) for i, n in enumerate([5, 5, 5, 20, 1, 1, 1, 1])], "doc int, page long, text string")
    out = {r.page: r.batch for r in windows.prompt_batches(df, "doc", "page", "text", 3, 12).collect()}
    assert out == {0: 0, 1: 0, 2: 1, 3: 2, 4: 3, 5: 3, 6: 3, 7: 4}


def test_binding(spark):
    products = spark.createDataFrame([(0, "p", "AB-100/AB-200"), (1, "p", "ab-100"), (2, "p", "none"), (3, "q", "AB-100")], "seq long, scope string, product_model string")
    known = spark.createDataFrame([("p", "AB-100"), ("p", "AB-200X"), ("p", "AB-200"), ("p", "B")], "scope string, model string")
    got = sorted((r.seq, r.known_model) for r in matching.bind_to_known_models(products, known, ["scope"]).collect())
    assert got == [(0, "AB-100"), (0, "AB-200"), (0, "B"), (1, "AB-100")]


def test_occurrences(spark):
    names = spark.createDataFrame([("VRV",), ("a very long series name",), ("x",)], "name string")
    pages = spark.createDataFrame([(1, "The V-RV unit"), (2, "A VERY LONG, series name here"), (3, None)], "page long, text string")
    assert {r.name: r.pages for r in matching.occurrences(names, pages, "name", "page", "text").collect()} == {"VRV": [1], "a very long series name": [2]}


def test_occurrences_against_brute_force(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choices("abA-é机组 ", k=r.randint(0, 16)))
    names, pages = [None, "", "a", *(word() for _ in range(150))], [None, "", *("".join(word() for _ in range(r.randint(0, 30))) for _ in range(60))]
    names += [p[5:40] for p in pages if p and len(p) > 45] + names[:20]
    key = lambda s: "".join(c for c in (s or "").lower() if c in "ab机组")
    brute = {(n, k) for n in names for k, p in enumerate(pages) if len(key(n)) >= 2 and key(n) in key(p)}
    left = spark.createDataFrame([(n, 1) for n in names], "name string, _key int")
    right = spark.createDataFrame([(k, p, "x") for k, p in enumerate(pages)], "page long, text string, name string")
    got = [tuple(x) for x in matching.occurrence_pairs(left, right, "name", "page", "text").collect()]
    assert sorted(got) == sorted(brute) and max(len(key(n)) for n, _ in brute) > 12
    plan = matching.occurrence_pairs(left, right, "name", "page", "text")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert matching.occurrence_pairs(left.limit(0), right, "name", "page", "text").count() == 0 == matching.occurrence_pairs(left, right.limit(0), "name", "page", "text").count()


def test_new_urls(spark):
    rows = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, None)], "seq long, url string")
    stored = spark.createDataFrame([("b",)], "url string")
    assert [(r.seq, r.url) for r in matching.new_urls(rows, stored).collect()] == [(0, "a")]
    assert matching.known_urls(rows, stored).count() == 1


def test_owner_ties_go_to_larger_pair_key(spark):
    rows = [("b", "m", f"b|||s{i}", 1, 1, 0, 1, 1, 1) for i in range(3)]
    df = spark.createDataFrame(rows, "brand string, model_key string, pair_key string, overlap_global int, overlap_local int, series_hits int, local_pages int, evidence_count int, series_pages int")
    assert knowledge.model_owners(df).where("rank = 1").first().pair_key == "b|||s2"


def test_graph_upsert(spark):
    rows = [(0, "B", "S", "C", "M", "old"), (1, "B", "S", "C", "M", None), (2, "", "", "", "", None)]
    df = spark.createDataFrame(rows, "seq long, brand string, series string, category string, product_model string, manufacturer string")
    nodes = {r.product_id: r.manufacturer for r in knowledge.product_nodes(df, ["manufacturer"]).collect()}
    assert nodes == {"B::M": "old", "record_2": None}
    assert {(r.rel, r.dst) for r in knowledge.edges(df).collect()} == {("BRANDED_BY", "B"), ("MANUFACTURED_BY", "old"), ("IN_CATEGORY", "C"), ("IN_SERIES", "S")}
    assert knowledge.broken_keys(knowledge.dimension_nodes(df), ["label", "key"]).count() == 0


def test_envelopes_keep_empty_batches(spark):
    batches = spark.createDataFrame([(0,), (1,), (2,)], "b int")
    results = spark.createDataFrame([(0, 0, "x", None), (1, 2, "y", [1, 0]), (2, 2, "z", None)], "seq int, b int, v string, _merged_from_batches array<int>")
    got = {r.b: [x.v for x in r.results] for r in knowledge.batch_envelopes(batches, results, "b", ["v"]).collect()}
    assert got == {0: ["x", "y"], 1: [], 2: ["z"]}


def test_threshold_follows_top_k(spark):
    v = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(1, 9)], "id long, vector array<double>")
    asked = v.where("id = 8").select(F.col("id").alias("query_id"), "vector")
    near = retrieval.nearest(asked, v, 3)
    assert [r.id for r in near.orderBy("rank").collect()] == [8, 7, 6]


def test_keywords_and_index(spark):
    docs = spark.createDataFrame([(1, "Alpha beta"), (2, "alpha"), (3, None)], "seq long, text string")
    assert [(r.seq, r.hits) for r in retrieval.by_keywords(docs, "text", ["ALPHA", "beta", "alpha"], top=5).collect()] == [(1, 2), (2, 1)]
    assert retrieval.by_keywords(docs, "text", []).count() == 3
    entries = retrieval.index_entries(spark.createDataFrame([(1, None, None, " ")], "id long, url string, title string, text string")).first()
    assert (entries.id, entries.url, entries.snippet) == ("1", "", " ")


@pytest.mark.parametrize(
    "line, out",
    [("Power: 3.5 kW", ("Power", "3.5", "kw")), ("Size(mm) = 10x20", ("Size", "10x20", "mm")), ("weight 12 kg", ("weight", "12", "kg")), ("no number", None), ("noise: low 3", ("noise", "low 3", "")), (None, None)],
)
def test_parse_line(spark, line, out):
    got = spark.createDataFrame([(line,)], "a string").select(parse_line("a").alias("s")).first().s
    assert (got and (got.name, got.value, got.unit)) == out


def test_specs(spark):
    df = spark.createDataFrame([(["quiet", "Power: 3 kW"],)], "lines array<string>")
    rest, specs = split_lines("lines")
    row = df.select(rest.alias("rest"), guard_units(specs, {"Power": "kW"}).alias("specs")).first()
    assert row.rest == ["quiet"] and row.specs[0].name == "Power"
    assert df.select(guard_units(specs, {"Power": "hp"}).alias("s")).first().s == []
    assert df.select(spec_name(F.lit("Rated Cooling Capacity"))).first()[0] == "cooling capacity"


def test_overflow_report(spark):
    rows = [("s", "h", 10 * i, None) for i in range(1, 12)] + [(None, " ", None, 7)]
    df = spark.createDataFrame(rows, "schema string, host string, prompt_tokens long, total_tokens long")
    got = {r.schema: r for r in quality.overflow_report(df, {"prompt_tokens": 50, "total_tokens": 100}).collect()}
    assert (got["s"].prompt_tokens_max, got["s"].prompt_tokens_p95, got["s"].suggested_split_factor, got["s"].hosts) == (110, 110 if round(10 * 0.95) == 10 else 100, 3, ["h"])
    assert (got["unknown_schema"].total_tokens_max, got["unknown_schema"].hosts) == (7, [])


def test_containment_and_linkage():
    rows = pd.DataFrame({"seq": [0, 1, 2, 3], "name": list("abcd"), "key": ["midea", "mideaco", "gree", ""], "pages": [["1"], ["2", "1"], ["3"], []]})
    out = clusters.merge_by_containment(rows)
    assert out["key"].tolist() == ["midea", "gree"] and out["pages"].tolist()[0] == ["1", "2"]
    import numpy as np

    assert clusters.average_linkage(np.array([[1.0, 0], [0.99, 0.1], [0, 1.0]]), 0.3) == [0, 0, 1]
