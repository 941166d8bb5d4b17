import pytest
from pyspark.sql import functions as F

from lodestar.functions import series as S
from lodestar.operators import reviews
from lodestar.sources import sinks


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "a string").select(column).first()[0]


@pytest.mark.parametrize(
    "name, out",
    [("[title] SDZD系列", "SDZD系列"), ("# GMV系列(上一代产品)", "GMV系列"), ("GMV系列(R410A)(上一代产品)", "GMV系列(R410A)(上一代产品)"), ("A系列 ① 参数", "A系列"), ("A系列 1) x", "A系列"), ("VRV系列说明", "VRV系列"), (" - ,B系列;", "B系列"), (None, "")],
)
def test_clean_name(spark, name, out):
    assert one(spark, S.clean_name("a"), name) == out
    assert one(spark, S.clean_name(S.clean_name("a")), name) == out


@pytest.mark.parametrize("name, out", [("SDZD系列室内机", True), ("GMV风管式室内机", True), ("多联机", False), ("bacnet网关系列", False), ("产品参数", False), ("VRV Series", True), ("x", False), (None, False)])
def test_is_series(spark, name, out):
    assert one(spark, S.is_series("a"), name) is out


@pytest.mark.parametrize("name, out", [("SDZD系列", "sdzd"), ("SDZD 室内机", "sdzd"), ("Delta Series", "delta"), ("风系列", "风"), ("美的系列室内机", "美的"), ("", "")])
def test_merge_key(spark, name, out):
    assert one(spark, S.merge_key("a"), name) == out


def test_split_and_extract(spark):
    assert one(spark, S.split_names("a"), "SDB系列室内机 SDK系列室外机") == ["SDB系列室内机", "SDK系列室外机"]
    assert one(spark, S.split_names("a"), "SDB系列室内机") == ["SDB系列室内机"]
    assert one(spark, S.split_names("a"), "") == []
    assert one(spark, S.coded_in_text("a"), "新品 SDTS系列风管室内机, GMV9热泵机组上市") == ["SDTS系列风管室内机", "GMV9热泵机组"]


def test_narrative(spark):
    assert one(spark, S.is_narrative("a"), "该系列延续了上一代的设计，采用全新技术") is True
    assert one(spark, S.is_narrative("a"), "SDZD系列") is False


def test_merge_series(spark):
    rows = [("b", "SDZD系列", ["e1"], ["1"], 0), ("b", "SDZD系列室内机", ["e2", "e1"], ["2"], 1), ("b", "空调", [], [], 2)]
    out = reviews.merge_series(spark.createDataFrame(rows, "brand string, name string, evidence array<string>, pages array<string>, seq long"), ["brand"]).collect()
    assert [(r.series_key, r.name, r.evidence, r.pages) for r in out] == [("sdzd", "SDZD系列室内机", ["e1", "e2"], ["1", "2"])]


def test_review_series(spark):
    candidates = spark.createDataFrame([("b", "Alpha Series"), ("b", "Beta Series"), ("b", "GX系列机组"), ("b", "Gamma Series")], "brand string, name string")
    verdicts = spark.createDataFrame([("b", "alpha series", True, "series", "Alpha S Series"), ("b", "Beta Series", False, "series", None), ("b", "GX系列", False, "other", None)], "brand string, original string, keep boolean, kind string, canonical string")
    assert sorted(r.canonical for r in reviews.review_series(candidates, verdicts).collect()) == ["Alpha S Series", "GX系列机组", "Gamma Series"]


def test_redirect_models(spark):
    models = spark.createDataFrame([("b", "S1", n) for n in ("stay", "move", "drop", "unsure")], "brand string, series string, name string")
    verdicts = spark.createDataFrame(
        [("b", "S1", "move", True, "model", "s2 系列", "", 0.9), ("b", "S1", "drop", False, "model", "", "", 1.0), ("b", "S1", "unsure", True, "model", "S2", "", 0.1)],
        "brand string, series string, name string, keep boolean, kind string, series_guess string, redirect_to string, confidence double",
    )
    known = spark.createDataFrame([("b", "S1"), ("b", "S2")], "brand string, series string")
    assert {r.name: r.series for r in reviews.redirect_models(models, verdicts, known).collect()} == {"stay": "S1", "move": "S2", "unsure": "S1"}
    assert "unsure" not in {r.name for r in reviews.redirect_models(models, verdicts, known, drop_mismatch=True).collect()}


def test_series_features_reach_products(spark):
    schema = "brand string, series string, features array<string>, fact_text array<string>, key_components array<string>"
    products = spark.createDataFrame([("b", "s", ["x"], None, []), ("b", "", ["x"], [], [])], schema)
    features = spark.createDataFrame([("b", "s", ["y", "x"], ["f"], ["c"], 0), ("b", "", ["z"], [], [], 1)], schema + ", seq long")
    out = reviews.add_series_features(products, features).orderBy(F.desc("series")).collect()
    assert (out[0].features, out[0].fact_text, out[0].key_components, out[1].features) == (["x", "y"], ["f"], ["c"], ["x"])


def test_table_slice(spark):
    df = spark.createDataFrame([("head\nunits\nAB-1 | 3\nAB-2 | 4\nAB-3 | 5", "ab-2")], "t string, m string")
    assert df.select(reviews.table_for_model("t", "m")).first()[0] == "head\nunits\nAB-2 | 4"
    assert df.select(reviews.table_for_model("t", "m", 1)).first()[0] == "head\nunits\nAB-1 | 3\nAB-2 | 4\nAB-3 | 5"
    assert df.select(reviews.table_for_model("t", F.lit("none"))).first()[0].count("\n") == 4


def test_single_brand_and_roles(spark):
    rows = spark.createDataFrame([(1, "A"), (1, ""), (2, "A"), (2, "B"), (2, None)], "doc int, brand string")
    assert sorted((r.doc, r.brand or "", r.brand_changed) for r in reviews.single_brand_scope(rows).collect()) == [(1, "A", False), (1, "A", True), (2, "", False), (2, "A", False), (2, "B", False)]
    assert one(spark, reviews.role_of("a", F.lit(True), F.lit(None).cast("boolean")), None) == "series_feature"


def test_insert_new_is_repeatable(spark, tmp_path):
    rows = sinks.crawl_rows(spark.createDataFrame([(0, "u", ["t"], ["a", "b"]), (1, "u", None, None), (2, "v", [], None)], "seq long, url string, titles array<string>, content array<string>"))
    for _ in range(2):
        sinks.insert_new(spark, rows, str(tmp_path / "t"))
    got = sorted((r.url, r.title, r.content) for r in spark.read.parquet(str(tmp_path / "t")).collect())
    assert got == [("u", "t", "a\nb"), ("v", "", "")]
    with pytest.raises(ValueError):
        sinks.assert_unique(rows, ["url"])
