import random

import pytest
from pyspark.sql import functions as F

from lodestar.functions import text as T


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def similarity(a, b):
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    a, b = a.strip().lower(), b.strip().lower()
    return 1.0 if a == b else 1 - distance(a, b) / max(len(a), len(b))


def test_edit_similarity(spark):
    r = random.Random(1)
    words = ["", " ", "美的", "美的集团", "Daikin"] + ["".join(r.choices("abAB 美", k=r.randint(0, 8))) for _ in range(60)]
    pairs = [(r.choice(words), r.choice(words)) for _ in range(200)]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", T.edit_similarity("a", "b").alias("s")).collect()
    for row in got:
        assert row.s == pytest.approx(similarity(row.a, row.b)), row


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize("name, core", [("格力电器股份有限公司", "格力股份有限"), ("LG Group-1", "lggroup1"), ("", ""), (None, "")])
def test_brand_core(spark, name, core):
    assert one(spark, T.brand_core("a"), a=name) == core


@pytest.mark.parametrize("name, out", [(" mdv－280w ", "MDV-280W"), ("a++b+", "A+B"), ("（x），，y", "(X),Y"), (None, "")])
def test_model_name(spark, name, out):
    assert one(spark, T.model_name("a"), a=name) == out
    assert one(spark, T.model_name(T.model_name("a")), a=name) == out


@pytest.mark.parametrize(
    "fields, out",
    [(("B", "S", "C", "M"), "B::M"), (("", "S", "C", "M"), "M"), (("B", "S", "C", " "), "B::S"), (("B", "", "C", None), "B::C"), (("", "S", "C", ""), "record_1")],
)
def test_product_id(spark, fields, out):
    b, s, c, m = fields
    assert one(spark, T.product_id("b", "s", "c", "m", F.lit("record_1")), b=b, s=s, c=c, m=m) == out


@pytest.mark.parametrize("name, out", [("风管室内机", "室内机"), ("外机A", "室外机"), ("压缩机", "室外机"), ("阀门", None), (None, None)])
def test_category(spark, name, out):
    assert one(spark, T.category_of("a"), a=name) == out


@pytest.mark.parametrize("value, out", [("10~20kW", True), ("5.6/7.1 HP", True), ("10kW", False), ("abc 1-2", False), (None, False)])
def test_numeric_range_title(spark, value, out):
    assert one(spark, T.numeric_range_title("a"), a=value) is out


@pytest.mark.parametrize("reply, out", [('{"a":1}', '{"a":1}'), ('x ```json\n{"a":2}\n``` y', '{"a":2}'), ('```\n{"a":3}\n```', '{"a":3}'), ('text {"a":4} text', None)])
def test_json_in_reply(spark, reply, out):
    assert one(spark, F.to_json(T.json_in_reply("a")) if out else T.json_in_reply("a"), a=reply) == out


def test_lists(spark):
    assert one(spark, T.distinct_list("a"), a=[" x", "y", None, "x", " "]) == ["x", "y"]


def test_clipped_and_links(spark):
    assert one(spark, T.clipped("a", 3), a="abcd") == "abc..."
    assert one(spark, T.clipped("a", 4), a="abcd") == "abcd"
    assert one(spark, T.article_link("a"), a="/news/1") is True
    assert one(spark, T.article_link("a"), a="/news/1#x") is False
    assert one(spark, T.article_link("a"), a=None) is False
