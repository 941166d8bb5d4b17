"""Brand aliases: candidate pairs, rules, groups, rewriting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.text import brand_core, edit_similarity, trimmed
from lodestar.operators.components import connected_components


def brand_table(entities: DataFrame, seq: str = "seq") -> DataFrame:
    """(idx, brand, freq, core): the distinct brands, the most frequent first."""
    rows = entities.where(trimmed("brand") != "").groupBy(trimmed("brand").alias("brand")).agg(F.count("*").alias("freq"), F.min(seq).alias("first_seq"))
    order = Window.orderBy(F.desc("freq"), "first_seq")  # over distinct brands, not rows
    return rows.withColumn("idx", F.row_number().over(order)).select("idx", "brand", "freq", brand_core("brand").alias("core"))


def shared_letters(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(F.split(a, ""), F.split(b, "")))


def worth_comparing(low_freq: int = 3, frequent: int = 20, shared: int = 2, ratio: float = 0.65, strict: float = 0.72, short: int = 3) -> Column:
    """May the brands a and b (prefixes ``a.`` and ``b.``) be one? The rules in order, the first that fits decides."""
    x, y = F.col("a.core"), F.col("b.core")
    lx, ly = F.length(x), F.length(y)
    rarest, commonest = F.least("a.freq", "b.freq"), F.greatest("a.freq", "b.freq")
    letters, alike = shared_letters(x, y), edit_similarity(x, y)
    rare = rarest <= low_freq
    return (
        F.when((x == "") | (y == ""), False)
        .when((commonest < frequent) & rare, False)
        .when((x == y) | F.contains(x, y) | F.contains(y, x), True)
        .when((F.abs(lx - ly) > 8) & (lx > 4) & (ly > 4), False)
        .when(letters >= shared, True)
        .when(rare & (F.substring(x, 1, 1) != F.substring(y, 1, 1)) & (alike < 0.8), False)
        .when(rare & (alike >= strict), True)
        .when(~rare & (alike >= ratio), True)
        .when((F.least(lx, ly) <= short) & (letters > 0), True)
        .otherwise(False)
    )


def _in_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """Rows with the block that they are in and, once for each, every block that it meets as (i, j), the smaller first."""
    own = rows.withColumn("own", F.pmod(F.xxhash64("idx"), F.lit(blocks)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return own.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})


def brand_pairs(brands: DataFrame, low_freq: int = 3, frequent: int = 20, block: int = 1024) -> DataFrame:
    """Pairs (a before b in rank) worth comparing.

    A rare brand is only ever compared with a frequent one, so brands above the low
    frequency meet each other, and the others, which are most of a long list, meet the
    frequent ones. Both are dealt into blocks by their counts, and each pair meets once.
    """
    common = brands.where(F.col("freq") > low_freq)
    heads = brands.where(F.col("freq") >= frequent)
    n_common, n_heads = brands.agg(F.count_if(F.col("freq") > low_freq), F.count_if(F.col("freq") >= frequent)).first()
    blocks = max(1, -(-n_common // block))
    spread = _in_blocks(common, blocks)
    same = (F.col("a.i") == F.col("b.i")) & (F.col("a.j") == F.col("b.j")) & (F.col("a.own") == F.col("a.i")) & (F.col("b.own") == F.col("b.j"))
    both = spread.alias("a").join(spread.alias("b"), same & ((F.col("a.i") < F.col("a.j")) | (F.col("a.idx") < F.col("b.idx"))))
    parts = max(1, -(-n_heads // block))
    rare = brands.where(F.col("freq") <= low_freq).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = heads.withColumn("part", F.pmod(F.xxhash64("idx"), F.lit(parts)).cast("int"))
    mixed = dealt.alias("a").join(rare.alias("b"), F.col("a.part") == F.col("b.part"))
    fields = ["idx", "brand", "freq", "core"]
    pair = [F.struct(*(F.col(f"{side}.{c}") for c in fields)).alias(side) for side in "ab"]
    found = both.select(*pair).unionByName(mixed.select(*pair))
    turned = F.col("a.idx") > F.col("b.idx")
    found = found.select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"))
    found = found.where(worth_comparing(low_freq, frequent))
    return found.select(F.col("a.idx").alias("i"), F.col("b.idx").alias("j"), *(F.col(f"{side}.{c}").alias(f"{c}{n}") for c in ("brand", "freq", "core") for n, side in ((1, "a"), (2, "b"))))


def judge_by_rules(pairs: DataFrame) -> DataFrame:
    """Adds method, is_alias, canonical, confidence; all null where no rule decides."""
    a, b = F.col("brand1"), F.col("brand2")
    la, lb = F.length(a), F.length(b)
    inside = F.contains(a, b) | F.contains(b, a)
    shorter, longer = F.when(la < lb, a).otherwise(b), F.when(la < lb, b).otherwise(a)
    shorter_freq, longer_freq = F.when(la < lb, F.col("freq1")).otherwise(F.col("freq2")), F.when(la < lb, F.col("freq2")).otherwise(F.col("freq1"))
    commoner = F.when(F.col("freq1") >= F.col("freq2"), a).otherwise(b)
    rules = [
        (F.lower(trimmed(a)) == F.lower(trimmed(b)), "rule_exact_match", True, commoner, 1.0),
        ((F.abs(la - lb) > F.greatest(la, lb) * 0.7) & ~inside, "rule_length_diff", False, F.lit(None).cast("string"), 0.9),
        ((F.col("core1") != "") & (F.col("core1") == F.col("core2")), "rule_core_match", True, commoner, 0.92),
        (inside & (F.abs(la - lb) <= 10), "rule_contains", True, F.when(shorter_freq >= longer_freq, shorter).otherwise(longer), 0.85),
        (F.size(F.array_remove(F.array_intersect(F.split("core1", ""), F.split("core2", "")), "")) < 2, "rule_no_common", False, F.lit(None).cast("string"), 0.88),
    ]
    verdict = F.lit(None).cast("struct<method:string,is_alias:boolean,canonical:string,confidence:double>")
    for test, method, alias, canonical, confidence in reversed(rules):
        found = F.struct(F.lit(method).alias("method"), F.lit(alias).alias("is_alias"), canonical.alias("canonical"), F.lit(confidence).alias("confidence"))
        verdict = F.when(test, found).otherwise(verdict)
    return pairs.withColumn("verdict", verdict).select("*", "verdict.*").drop("verdict")


def accepted(judged: DataFrame, least: float = 0.8, similar: float = 0.82, protected: list[str] | None = None) -> DataFrame:
    """Pairs to unite: what the rules accept, and what a model accepts with confidence and likeness (more of it for protected brands)."""
    from lodestar.functions.text import PROTECTED_BRANDS

    names = protected or PROTECTED_BRANDS
    by_rule = F.col("method").startswith("rule_")
    inside = F.contains("core1", F.col("core2")) | F.contains("core2", F.col("core1"))
    guarded = F.col("core1").isin(names) & F.col("core2").isin(names)
    alike = edit_similarity("core1", "core2")
    by_model = (F.col("confidence") >= least) & (inside | (alike >= F.when(guarded, 0.9).otherwise(similar)))
    return judged.where(F.col("is_alias") & (by_rule | by_model))


def alias_groups(brands: DataFrame, pairs: DataFrame) -> DataFrame:
    """(brand, canonical, freq) of all brands: the canonical one is the most frequent of its component."""
    found = connected_components(pairs, "i", "j").withColumnRenamed("node", "idx")
    joined = brands.join(found, "idx", "left").withColumn("root", F.coalesce("component", F.col("idx").cast("long")))
    heads = brands.select(F.col("idx").cast("long").alias("root"), F.col("brand").alias("canonical"))
    return joined.join(heads, "root").select("brand", "canonical", "freq")


def apply_aliases(entities: DataFrame, groups: DataFrame) -> DataFrame:
    """Brands rewritten to canonical ones, with what they were."""
    found = groups.where("brand <> canonical").select(F.col("brand").alias("_alias"), "canonical")
    out = entities.withColumn("_alias", trimmed("brand")).join(found, "_alias", "left").drop("_alias")
    merged = F.col("canonical").isNotNull()
    return out.withColumn("brand_alias_merged", merged).withColumn("original_brand", F.when(merged, F.col("brand"))).withColumn("brand", F.coalesce("canonical", "brand")).drop("canonical")
