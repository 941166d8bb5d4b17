"""Text rules as Column expressions, so that Catalyst sees through them.

"Blank" means null or empty (``blank``) or also white space only (``blank_trimmed``).
Character classes are Unicode-aware, lengths are code points.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Name = Column | str

#: Organisation words that a brand name loses, in this order.
ORGANISATION_WORDS = ["集团", "公司", "有限公司", "股份有限公司", "电器", "工业", "株式会社", "株式會社"]
#: Brands that only near-identical names may join.
PROTECTED_BRANDS = ["美的", "格力", "海尔", "大金", "日立", "东芝", "三菱", "三菱电机", "三菱重工", "松下", "lg", "panasonic", "daikin", "hitachi", "toshiba", "gree", "carrier", "trane", "york", "aux"]
#: Words that tell indoor from outdoor units; the first list is looked at first.
INDOOR_WORDS = ["风管", "室内", "吊顶", "嵌入", "落地", "壁挂", "挂壁", "新风", "全热", "除湿", "内机", "厨房", "管道", "吊落"]
OUTDOOR_WORDS = ["室外机", "外机", "主机", "压缩机", "冷凝器", "室外", "户外"]


def col(c: Name) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body`` of a value that it may use often, without the expression of the value being repeated."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def trimmed(c: Name) -> Column:
    """Without white space of any kind at both ends; null becomes empty."""
    return F.regexp_replace(F.coalesce(col(c).cast("string"), F.lit("")), r"(?U)^\s+|\s+$", "")


def blank(c: Name) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit("")) == ""


def blank_trimmed(c: Name) -> Column:
    return trimmed(c) == ""


def as_list(c: Name) -> Column:
    """Trimmed, non-blank strings of an array; a null array is empty."""
    return F.filter(F.transform(F.coalesce(col(c), F.array().cast("array<string>")), trimmed), lambda x: x != "")


def distinct_list(c: Name) -> Column:
    """Non-blank entries, each once, in the order of their first appearance."""
    return F.array_distinct(as_list(c))


def edit_similarity(a: Name, b: Name) -> Column:
    """1 - edit distance / longer length, ignoring case and outer space; two blanks are alike, one is not."""
    a, b = F.coalesce(col(a), F.lit("")), F.coalesce(col(b), F.lit(""))
    x, y = F.lower(trimmed(a)), F.lower(trimmed(b))
    longer = F.greatest(F.length(x), F.length(y))
    return (
        F.when((a == "") & (b == ""), F.lit(1.0))
        .when((a == "") | (b == ""), F.lit(0.0))
        .when(x == y, F.lit(1.0))
        .otherwise(F.lit(1.0) - F.levenshtein(x, y) / F.nullif(longer, F.lit(0)).cast("double"))
    )


#: Weights of the fields of an entity in its similarity with another one.
ENTITY_WEIGHTS = {"brand": 0.3, "product_model": 0.4, "manufacturer": 0.2, "series": 0.1}


def entity_similarity(left: str, right: str, weights: dict[str, float] | None = None) -> Column:
    """Weighted mean over the fields that both sides have; 0 where one has no model.

    ``left`` and ``right`` are column name prefixes such as ``q.``.
    """
    weights = weights or ENTITY_WEIGHTS
    score, used = F.lit(0.0), F.lit(0.0)
    for name, weight in weights.items():
        a, b = col(f"{left}{name}"), col(f"{right}{name}")
        both = ~blank_trimmed(a) & ~blank_trimmed(b)
        score += F.when(both, F.lit(weight) * edit_similarity(a, b)).otherwise(0.0)
        used += F.when(both, F.lit(weight)).otherwise(0.0)
    models = ~blank_trimmed(f"{left}product_model") & ~blank_trimmed(f"{right}product_model")
    return F.when(models, score / used).otherwise(0.0)


def normal_field(c: Name) -> Column:
    """A field as entities compare it: trimmed, lower case."""
    return F.lower(trimmed(c))


def _weighted(left: str, right: str, weights: dict[str, float], apart) -> Column:
    """Weighted mean over the prepared fields that both sides have, of 1 - apart / longer length; 0 where one has no model."""
    score, used = F.lit(0.0), F.lit(0.0)
    for name, weight in weights.items():
        a, b = col(f"{left}{name}"), col(f"{right}{name}")
        both = (a != "") & (b != "")
        alike = F.when(a == b, F.lit(1.0)).otherwise(F.lit(1.0) - apart(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1)).cast("double"))
        score += F.when(both, F.lit(weight) * alike).otherwise(0.0)
        used += F.when(both, F.lit(weight)).otherwise(0.0)
    models = (col(f"{left}product_model") != "") & (col(f"{right}product_model") != "")
    return F.when(models, score / used).otherwise(0.0)


def normal_similarity(left: str, right: str, weights: dict[str, float]) -> Column:
    """:func:`entity_similarity` of fields that :func:`normal_field` has prepared, so that no pair prepares them again."""
    return _weighted(left, right, weights, F.levenshtein)


def normal_bound(left: str, right: str, weights: dict[str, float]) -> Column:
    """At least :func:`normal_similarity`: an edit distance is no less than the difference of the lengths."""
    return _weighted(left, right, weights, lambda a, b: F.abs(F.length(a) - F.length(b)))


def brand_core(c: Name) -> Column:
    """Lower case without the organisation words, one after the other, and without anything but word characters."""
    text = F.lower(trimmed(c))
    for word in ORGANISATION_WORDS:
        text = F.replace(text, F.lit(word), F.lit(""))
    return F.regexp_replace(text, r"(?U)[^\w]", "")


def plain_key(c: Name) -> Column:
    """Lower case without white space."""
    return F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), r"(?U)\s+", "")


def brand_key(c: Name) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "[^a-z0-9一-龥]+", "")


def series_key(c: Name) -> Column:
    return F.replace(brand_key(c), F.lit("系列"), F.lit(""))


def model_name(c: Name) -> Column:
    """Half-width signs, no white space, single separators, no empty ``+`` parts, upper case."""
    text = F.translate(F.coalesce(col(c), F.lit("")), "（）【】［］｛｝，；：＋－／　", "()[][]{},;:+-/ ")
    text = F.regexp_replace(text, r"(?U)\s+", "")
    text = F.regexp_replace(F.regexp_replace(text, r"\++", "+"), ",+", ",")
    return F.upper(F.array_join(F.filter(F.split(text, r"\+"), lambda x: x != ""), "+"))


def pair_key(*parts: Name) -> Column:
    return F.concat_ws("|||", *(F.coalesce(col(p), F.lit("")) for p in parts))


def coarse_key(manufacturer: Name, category: Name, model: Name) -> Column:
    """The block of an entity: first letter of the manufacturer, else start of the category, else of the model."""
    m, c, p = (F.coalesce(col(x), F.lit("")) for x in (manufacturer, category, model))
    return (
        F.when(m != "", F.concat(F.lit("mfg_"), F.lower(F.substring(m, 1, 1))))
        .when(c != "", F.concat(F.lit("cat_"), F.substring(c, 1, 3)))
        .when(p != "", F.concat(F.lit("model_"), F.lower(F.substring(p, 1, 2))))
        .otherwise("unknown")
    )


def quick_fields() -> dict[str, Column]:
    """What :func:`quick_score` compares of an entity."""
    return {
        "q_start": F.lower(F.substring(F.coalesce("product_model", F.lit("")), 1, 5)),
        "q_maker": F.lower(F.substring(F.coalesce("manufacturer", F.lit("")), 1, 1)),
        "q_category": F.coalesce("category", F.lit("")),
    }


def quick_score(left: str, right: str) -> Column:
    """Cheap likeness of two entities by their quick fields: start of the model, first letter of the manufacturer, category."""
    a, b = col(f"{left}q_start"), col(f"{right}q_start")
    model = (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))
    same = lambda c: (col(f"{left}{c}") != "") & (col(f"{left}{c}") == col(f"{right}{c}"))
    return F.when(model, 0.5).otherwise(0.0) + F.when(same("q_maker"), 0.3).otherwise(0.0) + F.when(same("q_category"), 0.2).otherwise(0.0)


def confidence_band(c: Name, high: float = 0.75, medium: float = 0.6) -> Column:
    return F.when(col(c) >= high, "high").when(col(c) >= medium, "medium").when(col(c) > 0, "low").otherwise("failed")


def category_of(c: Name, indoor: list[str] | None = None, outdoor: list[str] | None = None, labels: tuple[str, str] = ("室内机", "室外机")) -> Column:
    """Label by key word; null where there is none."""
    has = lambda words: reduce(lambda a, b: a | b, (F.contains(F.coalesce(col(c), F.lit("")), F.lit(w)) for w in words))
    return F.when(has(indoor or INDOOR_WORDS), labels[0]).when(has(outdoor or OUTDOOR_WORDS), labels[1])


def product_id(brand: Name, series: Name, category: Name, model: Name, fallback: Name) -> Column:
    """brand::model, else model, else brand::series, else brand::category, else the fallback."""
    b, s, c, m = (F.nullif(trimmed(x), F.lit("")) for x in (brand, series, category, model))
    two = lambda x, y: F.when(x.isNotNull() & y.isNotNull(), F.concat(x, F.lit("::"), y))
    return F.coalesce(two(b, m), m, two(b, s), two(b, c), col(fallback))


def completeness(fields: dict[str, Name], lists: list[Name]) -> Column:
    """10 for each key field, 5 for each secondary field and non-empty list, at most 100."""
    weight = {"brand": 10, "category": 10, "series": 10, "product_model": 10, "manufacturer": 5, "refrigerant": 5, "energy_efficiency_grade": 5}
    total = F.lit(0)
    for name, c in fields.items():
        total += F.when(~blank_trimmed(c), weight[name]).otherwise(0)
    for c in lists:
        total += F.when(F.coalesce(F.size(col(c)), F.lit(0)) > 0, 5).otherwise(0)
    return F.least(total, F.lit(100))


def clipped(c: Name, n: int) -> Column:
    """The first ``n`` characters, with dots if there are more."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(col(c))


def safe_int(c: Name, default: int = 0) -> Column:
    return F.coalesce(trimmed(c).try_cast("int"), F.lit(default))


def backoff(attempt: Name, base: float = 2.0, factor: float = 2.5, longest: float = 120.0) -> Column:
    return F.least(F.lit(longest), F.lit(base) * F.pow(F.lit(factor), col(attempt)))


def keyword_hits(c: Name, words: list[str]) -> Column:
    """How many of the distinct words occur, ignoring case."""
    text = F.lower(F.coalesce(col(c), F.lit("")))
    distinct = list(dict.fromkeys(w.lower() for w in words if w.strip()))
    return reduce(lambda a, b: a + b, (F.contains(text, F.lit(w)).cast("int") for w in distinct), F.lit(0))


def numeric_range_title(c: Name) -> Column:
    """A heading that is only a range of numbers, perhaps with kW, HP or another unit."""
    text = F.regexp_replace(F.lower(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?U)\s+", "")), "kw|hp|匹|℃|°c|mm|m²", "")
    numbers = F.size(F.regexp_extract_all(text, F.lit(r"\d+(?:\.\d+)?"), F.lit(0)))
    return text.rlike(r"^[0-9./~+\-x×*()]+$") & (numbers >= 2) & text.rlike(r"[~\-/x×*]")


def plausible_brand(c: Name) -> Column:
    text = trimmed(c)
    return F.length(text).between(2, 24) & ~text.rlike(r"[0-9/|]") & ~text.rlike("型号|系列|参数|规格|说明|手册|目录|产品|公司地址")


def non_model_value(c: Name) -> Column:
    """A number, a range of numbers, or a number with a unit: no model name."""
    text = trimmed(c)
    return text.rlike(r"^\d+(\.\d+)?$") | text.rlike(r"^\d+(\.\d+)?\s*[-~]\s*\d+(\.\d+)?$") | text.rlike(r"(?i)^\d+(\.\d+)?\s*(mm|cm|m|kg|w|kw|v|a|hz|pa|db|%|℃)$")


def article_link(href: Name) -> Column:
    """A link that may lead to an article."""
    text = F.lower(F.coalesce(col(href), F.lit("")))
    return ~text.rlike("#|javascript:|mailto:|tel:") & text.rlike("article|news|post|detail|content|/id/|/item/")


def json_in_reply(c: Name) -> Column:
    """The JSON document of a reply: the whole text, a ```json block, or any ``` block; else null."""
    block = lambda mark: F.nullif(F.regexp_extract(col(c), rf"(?s)```{mark}\s*(.*?)\s*```", 1), F.lit(""))
    return F.coalesce(F.try_parse_json(col(c)), F.try_parse_json(block("json")), F.try_parse_json(block("")))


def yes_in_reply(c: Name) -> Column:
    """true, false or null by key words, positive ones first."""
    text = F.lower(F.coalesce(col(c), F.lit("")))
    return F.when(text.rlike("true|yes|是的|正确|相同"), True).when(text.rlike("false|no|否|不是|不同"), False)


def connection_error(c: Name) -> Column:
    return F.lower(F.coalesce(col(c), F.lit(""))).rlike("connection (error|reset|refused|aborted)|apiconnectionerror|connecterror|timed? ?out|name resolution|network is unreachable|remote protocol error")


def overflow_error(*parts: Name) -> Column:
    """A call that failed for the size of its input."""
    return F.lower(F.concat_ws(" | ", *(col(p) for p in parts))).rlike("context_length_exceeded|maximum context length|length limit|too many tokens|max_tokens|lengthfinishreason")


#: The fields of an entity in the order in which texts show them, and what stands for an entity or a comparison without any.
SHOWN_FIELDS = ["brand", "product_model", "category", "series", "manufacturer"]
ENTITY_TEXT_FIELDS = ["brand", "product_model", "manufacturer", "series", "category"]
NO_DETAILS, NO_SIMILARITY, NOTE = "无详细信息", "无相似度数据", "缺失"


def entity_text(fields: list[str] | None = None) -> Column:
    """The filled fields of an entity, trimmed, with a bar between each two."""
    return F.concat_ws(" | ", *(F.nullif(trimmed(c), F.lit("")) for c in fields or ENTITY_TEXT_FIELDS))


def format_entity(fields: list[str] | None = None, lists: list[str] | None = None, most: int = 5) -> Column:
    """An entity as lines of its filled fields; of a list the first few entries, and how many there are."""
    lines = [F.when(~blank(c), F.concat(F.lit(f"- {c}: "), col(c).cast("string"))) for c in (SHOWN_FIELDS if fields is None else fields)]
    for c in lists or []:
        n = F.size(col(c))
        rest = F.when(n > most, F.concat(F.lit(" ... (共"), n.cast("string"), F.lit("项)"))).otherwise("")
        lines.append(F.when(n > 0, F.concat(F.lit(f"- {c}: "), F.array_join(F.slice(col(c), 1, most), ", "), rest)))
    return F.coalesce(F.nullif(F.concat_ws("\n", *lines), F.lit("")), F.lit(NO_DETAILS))


def similarity_details(left: str, right: str, weights: dict[str, float] | None = None) -> Column:
    """For each field of two entities its weight and similarity, which is null, with a note, where one lacks the field."""
    def one(name: str, weight: float) -> Column:
        a, b = col(f"{left}{name}"), col(f"{right}{name}")
        both = ~blank_trimmed(a) & ~blank_trimmed(b)
        return F.struct(F.lit(name).alias("field"), F.lit(weight).alias("weight"), F.when(both, edit_similarity(a, b)).alias("similarity"), F.when(~both, F.lit(NOTE)).alias("note"))

    return F.array(*(one(n, w) for n, w in (weights or ENTITY_WEIGHTS).items()))


def format_similarity(details: Name) -> Column:
    """:func:`similarity_details` as lines."""
    line = lambda d: F.concat(F.lit("- "), d["field"], F.lit(": "), F.coalesce(F.format_string("%.3f", d["similarity"]), d["note"], F.lit(NOTE)))
    shown = F.transform(col(details), lambda d: F.when(d["similarity"].isNull(), F.concat(F.lit("- "), d["field"], F.lit(": "), F.coalesce(d["note"], F.lit(NOTE)))).otherwise(line(d)))
    return F.coalesce(F.nullif(F.array_join(shown, "\n"), F.lit("")), F.lit(NO_SIMILARITY))


def series_hits(name: Name, evidence: Name) -> Column:
    """In how many pieces of evidence a series is named, by its key, if that has two characters."""
    return let(series_key(name), lambda key: F.when(F.length(key) < 2, 0).otherwise(F.size(F.filter(as_list(evidence), lambda e: F.contains(series_key(e), key)))))


def about_series(c: Name) -> Column:
    """A text that speaks of a series and not of a model."""
    text = F.coalesce(col(c), F.lit(""))
    return F.contains(text, F.lit("系列")) | F.contains(F.lower(text), F.lit("series"))


def compact_properties(c: Name) -> Column:
    """A map of JSON values without those that are null, an empty list or an empty object; empty texts and zeros stay."""
    return F.map_filter(col(c), lambda _, v: v.isNotNull() & ~F.regexp_replace(v, r"\s", "").isin("null", "[]", "{}"))


def iso_time(c: Name) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss")


def whole_seconds(start: Name, end: Name) -> Column:
    """Seconds between two times, without fractions."""
    return F.floor(col(end).cast("timestamp").cast("double") - col(start).cast("timestamp").cast("double")).cast("long")


def error_facts(c: Name, longest: int = 4) -> Column:
    """From an error's text (a chain with ``caused by``): its kind, code, host and root, of a chain of at most ``longest``."""
    chain = F.slice(F.transform(F.split(F.coalesce(col(c), F.lit("")), r"(?i)\s*caused by:?\s*"), lambda x: F.trim(x)), 1, longest)
    kind = lambda x: F.nullif(F.regexp_extract(x, r"^([A-Za-z_][\w.]*(?:Error|Exception|Timeout))\b", 1), F.lit(""))
    return F.struct(
        kind(F.get(chain, F.lit(0))).alias("error_type"),
        F.nullif(F.regexp_extract(col(c), r"(?i)(?:error[ _]code|status(?:[ _]code)?|code)\W{1,4}([A-Za-z0-9_]+)", 1), F.lit("")).alias("error_code"),
        F.nullif(F.regexp_extract(col(c), r"https?://([^/\s:?#'\"]+)", 1), F.lit("")).alias("request_host"),
        kind(F.element_at(chain, -1)).alias("root_error_type"),
        F.element_at(chain, -1).alias("root_error"),
        F.size(chain).alias("chain_length"),
    )


def click_strategy(href: Name, selector: Name) -> Column:
    """The first strategy that can handle an element: follow a usable link, open a card, or click."""
    target, where = F.trim(F.coalesce(col(href), F.lit(""))), F.coalesce(col(selector), F.lit(""))
    usable = (target != "") & ~target.startswith("#") & ~F.lower(target).startswith("javascript:")
    return F.when(usable, "direct_link").when(F.contains(where, F.lit("article-card")) | F.contains(where, F.lit("container")), "card").otherwise("click")
