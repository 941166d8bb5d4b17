"""Specification lines and entries: parsing, units, names, one value for each name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.functions.text import col, let, Name, trimmed

#: Units that may end a name or a value.
UNITS = ["mm", "cm", "m", "m3/h", "l/min", "ml/min", "kg", "g", "w", "kw", "a", "v", "hz", "pa", "kpa", "mpa", "%", "db", "db(a)", "rpm"]

SPEC = "struct<name:string,value:string,unit:string,raw:string>"


def _unit_pattern(units: list[str]) -> str:
    """Alternatives, longest first, so that a longer unit wins over its own ending."""
    special = "\\.+*?()[]{}|^$"
    return "|".join("".join("\\" + c if c in special else c for c in u) for u in sorted(units, key=lambda u: (-len(u), u)))


def parse_line(line: Name, units: list[str] | None = None) -> Column:
    """(name, value, unit, raw) of ``name: value`` or of a name followed by its number; null for any other line.

    The unit is what ends the value, if the rest of it is numeric, else what stands in
    brackets behind the name or ends the name.
    """
    pattern = _unit_pattern(units or UNITS)
    text = F.coalesce(col(line), F.lit(""))
    colon = r"(?U)^\s*([^:=：]+?)\s*[:=：]\s*(.+)$"
    compact = r"(?U)^\s*([^0-9φΦø]*[A-Za-z一-鿿][^0-9φΦø]*?)\s*([0-9φΦø].*?)\s*$"
    has_colon = text.rlike(colon)
    name = trimmed(F.when(has_colon, F.regexp_extract(text, colon, 1)).otherwise(F.regexp_extract(text, compact, 1)))
    value = F.translate(trimmed(F.when(has_colon, F.regexp_extract(text, colon, 2)).otherwise(F.regexp_extract(text, compact, 2))), "³", "3")
    split_value = rf"(?i)^\s*([0-9.\-~xX*/\s]*[0-9.\-~xX*/])\s*({pattern})\s*$"
    unit_of_value = F.lower(F.regexp_extract(value, split_value, 2))
    bracket = F.translate(F.regexp_extract(name, r"\(([^()]*)\)", 1), "³", "3")
    in_bracket = F.lower(bracket).rlike(rf"(?i){pattern}") & (bracket != "")
    ending = rf"(?i)({pattern})$"
    unit_of_name = F.when(in_bracket, trimmed(bracket)).otherwise(F.lower(F.regexp_extract(name, ending, 1)))
    bare = F.when(in_bracket, trimmed(F.regexp_replace(name, r"\([^()]*\)", ""))).otherwise(trimmed(F.regexp_replace(name, ending, "")))
    shown = F.when(unit_of_value != "", trimmed(F.regexp_extract(value, split_value, 1))).otherwise(value)
    parsed = F.struct(
        F.when(bare == "", name).otherwise(bare).alias("name"),
        shown.alias("value"),
        F.coalesce(F.nullif(unit_of_value, F.lit("")), unit_of_name, F.lit("")).alias("unit"),
        trimmed(text).alias("raw"),
    )
    return F.when(text.rlike("[0-9]") & (name != "") & (value != ""), parsed)


def split_lines(lines: Name, units: list[str] | None = None) -> tuple[Column, Column]:
    """(lines that are no specification, specifications) of an array of lines."""
    parsed = F.transform(F.coalesce(col(lines), F.array().cast("array<string>")), lambda x: F.struct(x.alias("line"), parse_line(x, units).alias("spec")))
    rest = F.transform(F.filter(parsed, lambda x: x["spec"].isNull()), lambda x: x["line"])
    return rest, F.transform(F.filter(parsed, lambda x: x["spec"].isNotNull()), lambda x: x["spec"])


def guard_units(specs: Name, expected: dict[str, str]) -> Column:
    """Drop entries without name or raw text, and those whose expected unit their raw text lacks; fill the unit; each entry once."""
    units = F.create_map(*(F.lit(x) for pair in expected.items() for x in pair)) if expected else F.create_map().cast("map<string,string>")
    want = lambda s: F.try_element_at(units, s["name"])
    good = F.filter(
        col(specs),
        lambda s: (trimmed(s["name"]) != "") & (trimmed(s["raw"]) != "") & (want(s).isNull() | F.contains(F.lower(s["raw"]), F.lower(F.coalesce(want(s), F.lit(""))))),
    )
    return F.array_distinct(
        F.transform(good, lambda s: F.struct(trimmed(s["name"]).alias("name"), trimmed(s["value"]).alias("value"), F.coalesce(F.nullif(trimmed(s["unit"]), F.lit("")), want(s), F.lit("")).alias("unit"), trimmed(s["raw"]).alias("raw")))
    )


def normal_specs(specs: Name) -> Column:
    """Entries with trimmed texts, none of them all blank, each once."""
    kept = F.transform(F.coalesce(col(specs), F.array().cast(f"array<{SPEC}>")), lambda s: F.struct(*(trimmed(s[f]).alias(f) for f in ("name", "value", "unit", "raw"))))
    return F.array_distinct(F.filter(kept, lambda s: F.concat(s["name"], s["value"], s["unit"], s["raw"]) != ""))


def spec_key(name: Name) -> Column:
    """A name for comparing: half-width brackets, lower case, no white space, no separators."""
    return F.regexp_replace(F.lower(F.translate(F.coalesce(col(name), F.lit("")), "（）：，", "():,")), r"(?U)[\s_\-:,]+", "")


#: What a specification is called by what its name contains; the first rule that fits wins.
SPEC_NAMES = [
    ("gas.*pipe|pipe.*gas", "gas pipe"), ("liquid.*pipe|pipe.*liquid", "liquid pipe"), ("\\bapf\\b", "APF"), ("\\bcop\\b", "COP"), ("\\beer\\b", "EER"),
    ("cool.*capacity|capacity.*cool", "cooling capacity"), ("heat.*capacity|capacity.*heat", "heating capacity"), ("cool.*power|power.*cool", "cooling power"), ("heat.*power|power.*heat", "heating power"),
    ("air.*(flow|volume)", "air flow"), ("static.*pressure", "static pressure"), ("noise|sound", "noise"), ("dimension|size|w.?×.?d.?×.?h", "dimensions"), ("weight|mass", "weight"), ("refrigerant", "refrigerant"),
    ("voltage|power supply", "power supply"), ("current", "current"), ("power", "power"), ("capacity", "capacity"),
]


def spec_name(name: Name) -> Column:
    """The canonical name by the first rule that fits, else the trimmed name."""
    text = F.lower(trimmed(name))
    found = F.lit(None).cast("string")
    for pattern, canonical in reversed(SPEC_NAMES):
        found = F.when(text.rlike(pattern), canonical).otherwise(found)
    return F.coalesce(found, trimmed(name))


#: Canonical names of specifications by the English phrases that name them, the first that occurs wins; words of a phrase may
#: have any white space between them or none.
ENGLISH_SPECS = [
    (["standard static pressure"], "标准静压"),
    (["static pressure range"], "静压范围"),
    (["static pressure"], "静压"),
    (["air flow", "circulating air volume", "cycle air volume"], "循环风量"),
    (["cooling capacity"], "制冷量"),
    (["heating capacity"], "制热量"),
    (["cooling input power", "cooling power consumption", "cooling power"], "制冷功率"),
    (["heating input power", "heating power consumption", "heating power"], "制热功率"),
    (["input power", "power consumption"], "耗电量"),
    (["noise", "sound pressure"], "噪音"),
    (["power supply", "voltage"], "电源"),
    (["frequency"], "频率"),
    (["drain pipe", "drainage pipe"], "排水管"),
    (["net weight"], "净重"),
    (["gross weight"], "毛重"),
    (["operating weight"], "运行重量"),
    (["weight"], "重量"),
    (["dimension", "dimensions"], "外形尺寸"),
    (["connection method"], "连接方式"),
    (["protection grade", "protection level"], "防护等级"),
    (["fuse current"], "保险丝电流"),
    (["circuit breaker capacity"], "断路器容量"),
    (["panel model"], "面板型号"),
    (["panel weight"], "面板重量"),
    (["refrigerant charge"], "冷媒充注量"),
    (["pipe diameter"], "管径"),
    (["coil water flow"], "盘管水流量"),
    (["rated power cooling"], "额定制冷功率"),
    (["rated power heating"], "额定制热功率"),
    (["power input"], "输入功率"),
    (["auxiliary heating", "auxiliary electric heating", "electric auxiliary heating", "optional auxiliary heating", "optional electric auxiliary heating"], "可选电辅热功率"),
]
#: Names that count only as the whole name; efficiency figures; pipes by what runs in them.
WHOLE_SPECS = {"power": "功率", "hp": "匹数"}
EFFICIENCIES = ["apf", "cop", "eer"]
PIPES = {"gas": "连接管气管", "liquid": "连接管液管"}
#: Chinese names that mean another one, names to look for in a raw text, and what a name found there must and must not contain.
CHINESE_SPECS = {"外机静压": "机外静压", "最高机外静压": "机外静压", "机外静压范围": "静压范围", "标准机外静压": "标准静压"}
RAW_SPECS = ["标准静压", "静压范围", "机外静压", "静压", "循环风量", "风量", "制冷量", "制热量", "制冷功率", "制热功率", "耗电量", "噪音", "电源", "连接管", "排水管", "外形尺寸", "净重", "毛重"]
RAW_NAME_PARTS = ["压", "量", "功率", "电流", "风量", "噪音", "电源", "频率", "尺寸", "重量", "管", "能效", "温度"]
RAW_NAME_STOPS = ["型号", "产品", "系列", "机组", "备注", "说明", "参数"]
#: Names that tell levels, the letters and words of levels, how letters combine, and orders of width, depth and height.
LEVELLED = ["风量", "噪音", "噪声", "规格"]
LEVELS = {"H": "高", "M": "中", "L": "低"}
LEVEL_WORDS = {"High": "高", "Medium": "中", "Low": "低"}
LEVEL_GROUPS = {"H/M/L": "高/中/低", "H/ML": "高/中低", "HML": "高中低", "H/W/L": "高/强/低"}
SIDES = {"WDH": "宽×深×高", "WHD": "宽×高×深"}


def _levels(name: Column) -> Column:
    """Levels in Chinese: groups and letters in brackets, groups and words by themselves, words and letters behind an underscore."""
    free = {group: LEVEL_GROUPS[group] for group in ("H/M/L", "H/ML")}
    steps = [(rf"\({x}\)", f"({y})") for x, y in (LEVEL_GROUPS | LEVELS).items()]
    steps += [(rf"\b{x}\b", y) for x, y in (free | LEVEL_WORDS).items()]
    steps += [(rf"_{x}\b", f"_{y}") for x, y in (LEVEL_WORDS | LEVELS).items()]
    for found, put in steps:
        name = F.regexp_replace(name, f"(?iU){found}", put)
    return name


def _any_in(text: Column, words: list[str]) -> Column:
    return text.rlike("|".join(words))


def _first_of(cases: list[tuple[Column, Column]]) -> Column:
    return F.coalesce(*(F.when(test, value) for test, value in cases))


def chinese_spec_name(name: Name) -> Column:
    """A Chinese name of a specification without white space, in its usual words and signs."""
    known = F.create_map(*(F.lit(x) for pair in CHINESE_SPECS.items() for x in pair))
    text = let(F.regexp_replace(F.coalesce(col(name), F.lit("")), r"(?U)\s+", ""), lambda n: F.coalesce(F.try_element_at(known, n), n))
    text = F.regexp_replace(text, r"(?i)(?<=[0-9一-龥)])x(?=[0-9一-龥(])", "×")
    for sides, words in SIDES.items():
        text = F.regexp_replace(text, rf"(?iU)\b{'[×x]'.join(sides)}\b", words)
    return let(text, lambda n: F.when(_any_in(n, LEVELLED), _levels(n)).otherwise(n))


def spec_name_in(raw: Name) -> Column:
    """The name that a raw text tells: a known one in it, or Chinese words in front of a colon or a digit that look like one; else empty."""
    text = trimmed(raw)
    dense = F.regexp_replace(text, r"(?U)\s+", "")
    known = _first_of([(F.contains(dense, F.lit(word)), chinese_spec_name(F.lit(word))) for word in RAW_SPECS])
    told = chinese_spec_name(F.regexp_extract(text, r"(?U)([一-龥]{2,16})\s*(?:[:：]|[0-9])", 1))
    return F.coalesce(known, let(told, lambda n: F.when(~_any_in(n, RAW_NAME_STOPS) & _any_in(n, RAW_NAME_PARTS), n)), F.lit(""))


def canonical_spec_name(name: Name, raw: Name) -> Column:
    """What a specification is called: Chinese names in their usual form, English ones by what they contain, else what the raw text tells, else as given."""
    given = trimmed(name)
    clean = F.regexp_replace(F.regexp_replace(given, r"(?U)\s+", " "), "^[ :：;；,，]+|[ :：;；,，]+$", "")

    def english(text: Column) -> Column:
        phrase = lambda p: r"\b" + r"\s*".join(p.split()) + r"\b"
        pipes = [(text.rlike(rf"pipe.*\b{what}\b|\b{what}\b.*pipe"), F.lit(word)) for what, word in PIPES.items()]
        figures = [(text.rlike(rf"\b{x}\b"), F.lit(x.upper())) for x in EFFICIENCIES]
        phrases = [(text.rlike("|".join(map(phrase, names))), F.lit(word)) for names, word in ENGLISH_SPECS]
        # the whole names come before the last of the phrases, which can't be one of them
        return _first_of([*pipes, *figures, *phrases, *((text == x, F.lit(word)) for x, word in WHOLE_SPECS.items())])

    found = let(clean, lambda n: F.when(n.rlike("[一-龥]"), chinese_spec_name(n)).otherwise(F.coalesce(let(F.lower(F.regexp_replace(n, r"[_\-]+", " ")), english), F.nullif(spec_name_in(raw), F.lit("")), n)))
    return F.when(given == "", spec_name_in(raw)).otherwise(found)
