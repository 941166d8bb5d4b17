import pytest
from pyspark.sql import functions as F

from lodestar.functions import specs
from lodestar.functions import text as T
from lodestar.operators import hierarchy, retrieval
from lodestar.sources import layout, records, web


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "name, raw, out",
    [("Airflow (H/M/L)", "", "循环风量"), ("gas_pipe", "", "连接管气管"), ("Power", "", "功率"), ("Power colour", "", "Power colour"), ("噪声(H)", "", "噪声(高)"), ("10x20", "", "10x20"), ("长 10x20", "", "长10×20"), (None, "净重：3", "净重"), ("", "说明量：3", ""), (" ; ", None, "")],
)
def test_canonical_spec_name(spark, name, raw, out):
    assert one(spark, specs.canonical_spec_name(F.lit(name).cast("string"), F.lit(raw).cast("string"))) == out


@pytest.mark.parametrize("text, out", [("a &amp;lt; b", "a &lt; b"), ("&eacute;&#233;&#xE9;&#x1F600;", "ééé😀"), ("&nope; & &#0; &apos;", "&nope; & &#0; '"), ("plain", "plain"), (None, None)])
def test_references(spark, text, out):
    assert one(spark, layout.unescape(F.lit(text).cast("string"))) == out


def test_formats(spark):
    row = spark.createDataFrame([(" b ", None, "", "s", ["1", "2", "3"])], "brand string, product_model string, manufacturer string, series string, tags array<string>")
    assert row.select(T.entity_text(["brand", "product_model", "manufacturer", "series"])).first()[0] == "b | s"
    assert row.select(T.format_entity(["series", "manufacturer"], ["tags"], 2)).first()[0] == "- series: s\n- tags: 1, 2 ... (共3项)"
    assert row.select(T.format_entity(["manufacturer"])).first()[0] == T.NO_DETAILS
    pair = spark.createDataFrame([("ab", "ac", "", "x")], "a string, b string, c string, d string")
    details = F.array(F.struct(F.lit("f").alias("field"), T.edit_similarity("a", "b").alias("similarity"), F.lit("").alias("note")), F.struct(F.lit("g").alias("field"), F.lit(None).cast("double").alias("similarity"), F.lit("gone").alias("note")))
    assert pair.select(T.format_similarity(details)).first()[0] == "- f: 0.500\n- g: gone"
    assert one(spark, T.compact_properties(F.create_map(F.lit("a"), F.lit("null"), F.lit("b"), F.lit("[ ]"), F.lit("c"), F.lit(""), F.lit("d"), F.lit("0")))) == {"c": "", "d": "0"}
    facts = one(spark, T.error_facts(F.lit("ReadTimeout: code=504 https://api.example:8/x caused by: ConnectionError refused")))
    assert (facts.error_type, facts.error_code, facts.request_host, facts.root_error_type, facts.chain_length) == ("ReadTimeout", "504", "api.example", "ConnectionError", 2)
    assert one(spark, T.series_hits(F.lit("GMV系列"), F.array(F.lit("the gmv"), F.lit("none"), F.lit(None)))) == 1 and one(spark, T.series_hits(F.lit("g"), F.array(F.lit("g")))) == 0


def test_links_against_a_page_address(spark):
    at = lambda base, href: one(spark, web.resolve(F.lit(base), F.lit(href)))
    assert at("http://h/a/b", "../../c/./d/../e") == "http://h/c/e" and at("http://h", "x") == "http://h/x" and at("http://h/a/", "..") == "http://h/"


def test_one_brand_takes_all_series(spark):
    schema = "doc int, seq long, brand string, name string, evidence array<string>, pages array<string>"
    series = spark.createDataFrame([(1, 0, "x", "GMV系列", ["e"], ["1"]), (1, 1, "y", "GMV系列室内机", ["f"], ["2"]), (2, 2, "x", "KX系列", [], []), (2, 3, "y", " ", [], [])], schema)
    brands = spark.createDataFrame([(1, "x"), (2, "x"), (2, "y")], "doc int, name string")
    rows = {(r.doc, r.brand, r.name): r for r in hierarchy.single_brand_series(brands, series).collect()}
    assert set(rows) == {(1, "x", "GMV系列室内机"), (2, "x", "KX系列")}
    assert rows[1, "x", "GMV系列室内机"].pages == ["1", "2"] and rows[1, "x", "GMV系列室内机"].changed and not rows[2, "x", "KX系列"].changed
    conflicts = spark.createDataFrame([(1, "y", "S", "m"), (2, "y", "S", "m")], "doc int, brand string, series string, model_key string")
    assert sorted((r.doc, r.pair_key, r.changed) for r in hierarchy.single_brand_conflicts(brands, conflicts).collect()) == [(1, "x|||S", True), (2, "y|||S", False)]


def test_brand_folders_and_reload(spark, tmp_path):
    for brand in ("Beta", "alpha", ".hidden", "gone"):
        (tmp_path / "root" / brand).mkdir(parents=True)
        for name in ("one.md", "two.md"):
            (tmp_path / "root" / brand / name).write_text("words " * 30)
    files = records.read_markdown(spark, str(tmp_path / "root" / "*"))
    root = f"file://{tmp_path}/root"
    found = [(r.brand, r.doc_key) for r in records.discover_brand_tasks(files, root, exclude=["gone"], limit=3).collect()]
    assert found == [("alpha", "one"), ("alpha", "two"), ("Beta", "one")]
    assert {r.brand for r in records.discover_brand_tasks(files, root, include=["Beta", " "]).collect()} == {"Beta"}
    assert records.brand_summary(records.discover_brand_tasks(files, root, include=["Beta"])).first().single_files == 2
    assert records.reload_products(spark, f"{tmp_path}/none", f"{tmp_path}/nothing").count() == 0


def test_small_things_of_retrieval(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [0.0, 1.0, 0.0])], "id long, vector array<double>")
    got = retrieval.nearest(df.select(F.col("id").alias("query_id"), "vector"), df, 3, block=2, query_block=2)
    assert sorted((r.query_id, r.id, r["rank"]) for r in got.collect()) == [(1, 1, 1), (1, 2, 2), (2, 1, 1), (2, 2, 2), (6, 6, 1)]
    assert one(spark, retrieval.distance_score(F.lit(3.0), "l2")) == 0.25 and retrieval.clear(df).count() == 0


def test_broken_envelopes_fail(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"results": [}')
    with pytest.raises(Exception, match="not JSON"):
        records.read_envelopes(spark, str(tmp_path / "x.json")).collect()
