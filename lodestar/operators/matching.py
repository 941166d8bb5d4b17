"""Joins by containment and existence: models in text, names on pages, stored URLs, dropped names."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.text import brand_key, model_name
from lodestar.operators.sieve import maybe_among


def bind_to_known_models(products: DataFrame, known: DataFrame, scope: list[str], cap: int = 12, gram: int = 4) -> DataFrame:
    """Products whose model is a known one of their scope, or contains known ones, longest first; others go.

    Containment candidates meet over a fragment: a known key's first ``gram`` letters
    occur in any text that contains it, so only rows that share it are compared.
    """
    keyed = products.withColumn("_key", model_name("product_model")).where("_key <> ''")
    names = known.select(*scope, model_name("model").alias("known_model")).where("known_model <> ''").distinct()
    exact = keyed.join(names.withColumn("_key", F.col("known_model")), [*scope, "_key"])
    rest = keyed.join(names.withColumn("_key", F.col("known_model")), [*scope, "_key"], "left_anti")
    starts = names.withColumn("_piece", F.substring("known_model", 1, gram))
    pieces = rest.withColumn("_piece", F.explode(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(gram)), lambda n: F.transform(F.sequence(F.lit(1), F.length("_key")), lambda i: F.substring(F.col("_key"), i, n)))))))
    inside = pieces.join(starts, [*scope, "_piece"]).where(F.contains("_key", "known_model")).drop("_piece").distinct()
    order = Window.partitionBy("seq").orderBy(F.length("known_model").desc(), "known_model")
    capped = inside.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= cap).drop("_rank")
    return exact.select(capped.columns).unionByName(capped).drop("_key")


def occurrence_pairs(names: DataFrame, pages: DataFrame, name: str, page: str, text: str, least: int = 2, gram: int = 12) -> DataFrame:
    """(name, page) where a name occurs on a page, both reduced to letters and digits; each pair once.

    They meet over the name's first ``gram`` characters, or all of a shorter name.  Every
    place of a page has a rolling hash for each of these lengths; a bitmap of fixed size
    lets through the few places where a name may begin, and only those are joined, with
    as many of the characters that follow as the names of that length need.  Names with
    fewer than ``least`` characters are nowhere, and nothing is on a null or empty page
    or one without an id.
    """
    keyed = names.select(F.col(name).alias("_name"), brand_key(name).alias("_key")).where(F.length("_key") >= max(1, least)).distinct()
    keyed = keyed.withColumns({"_n": F.least(F.length("_key"), F.lit(gram)), "_piece": F.substring("_key", 1, gram)})
    longest = {r["_n"]: r["_longest"] for r in keyed.groupBy("_n").agg(F.max(F.length("_key")).alias("_longest")).collect()}  # a row for each of the lengths up to gram
    marks = keyed.select("_piece").distinct().mapInPandas(_slots_of_names, "_slot long")
    mark = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("_slot", F.lit(64)).cast("int"))
    words = marks.groupBy(F.shiftright("_slot", 6).alias("_word")).agg(F.bit_or(mark).alias("_bits")).toPandas()  # a megabyte at most
    bitmap = np.zeros(1 << (SLOT_BITS - 6), dtype=np.uint64)
    bitmap[words["_word"].to_numpy(dtype=np.int64)] = words["_bits"].to_numpy(dtype=np.int64).view(np.uint64)
    body = pages.select(F.col(page).alias("_page"), brand_key(text).alias("_body")).where("_page IS NOT NULL AND _body <> ''")
    near = body.mapInPandas(_places(bitmap, longest), T.StructType([body.schema["_page"], *(T.StructField(c, T.StringType()) for c in ("_piece", "_follows"))]))
    found = near.join(keyed, "_piece").where(F.startswith("_follows", "_key"))
    return found.select(F.col("_name").alias(name), F.col("_page").alias(page)).distinct()


#: Bits of a slot's number in the bitmap of name beginnings: eight million slots, a megabyte.
SLOT_BITS = 23


def _slots(text: str, longest: int):
    """(n, slots of all fragments of n characters) for each n up to the given one."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    rolling = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, min(longest, len(codes)) + 1):
        rolling = rolling[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :]
        yield n, ((rolling ^ (rolling >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - SLOT_BITS)


def _slots_of_names(batches):
    for batch in batches:
        yield pd.DataFrame({"_slot": [int(list(_slots(piece, len(piece)))[-1][1][0]) for piece in batch["_piece"]]}, dtype="int64")


def _places(bitmap: np.ndarray, longest: dict[int, int], rows: int = 10_000):
    def places(batches):
        found: list[tuple] = []
        for batch in batches:
            for number, text in zip(batch["_page"], batch["_body"]):
                seen = set()
                for n, slots in _slots(text, max(longest, default=0)):
                    if n in longest:
                        hits = np.flatnonzero((bitmap[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1))
                        seen.update((number, text[at : at + n], text[at : at + longest[n]]) for at in hits.tolist())
                found += seen
                if len(found) >= rows:
                    yield pd.DataFrame(found, columns=["_page", "_piece", "_follows"])
                    found = []
        if found:
            yield pd.DataFrame(found, columns=["_page", "_piece", "_follows"])

    return places


def occurrences(names: DataFrame, pages: DataFrame, name: str, page: str, text: str, least: int = 2, gram: int = 12) -> DataFrame:
    """(name, pages): the sorted pages of each name that occurs on any. A name's pages have to fit a row."""
    pairs = occurrence_pairs(names, pages, name, page, text, least, gram)
    return pairs.groupBy(name).agg(F.array_sort(F.collect_set(F.col(page).cast("long"))).alias("pages"))


def occurrence_pairs_of_texts(items: DataFrame, docs: DataFrame, item: str, doc: str, text: str, words: int = 6) -> DataFrame:
    """(item, doc) where an item's whole text, word by word and without case, is inside a document.

    They meet over the item's first few words, or all of them if it has fewer.  Every
    place of a document has a hash of so many words; a bitmap of fixed size over the
    items' hashes lets through the few places that may begin an item, and only those
    are joined, with the words that follow. Items without words are in none.
    """
    clean = lambda c: F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(c), F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")
    hashed = lambda w: F.transform(w, lambda x: F.xxhash64(x))
    piece = lambda h, at, n: F.xxhash64(*(F.get(h, at + k) for k in range(n)))
    left = items.select(F.col(item), clean(text).alias("w")).withColumn("n", F.least(F.size("w"), F.lit(words))).where("w[0] <> ''")
    lengths = sorted(r.n for r in left.select("n").distinct().collect())  # as many as words at most
    left = left.withColumn("h", hashed("w"))
    start = F.coalesce(*(F.when(F.col("n") == n, piece(F.col("h"), F.lit(0), n)) for n in lengths or [words]))
    left = left.select(item, "n", F.size("w").alias("_size"), F.array_join("w", " ").alias("phrase"), start.alias("_piece"))
    right = docs.select(F.col(doc), clean(text).alias("w")).withColumn("h", hashed("w"))
    of = lambda n: F.when(F.size("h") >= n, F.transform(F.sequence(F.lit(0), F.size("h") - n), lambda i: F.struct(piece(F.col("h"), i, n).alias("_piece"), i.alias("at"), F.lit(n).alias("n")))).otherwise(F.array())
    places = right.select(doc, "w", F.explode(F.flatten(F.array(*(of(n) for n in lengths or [words])))).alias("p")).select(doc, "w", "p._piece", "p.at", "p.n")
    hits = maybe_among(places, "_piece", left).join(left, ["_piece", "n"])
    return hits.where(F.array_join(F.slice("w", F.col("at") + 1, F.col("_size")), " ") == F.col("phrase")).select(item, doc).distinct()


def new_urls(rows: DataFrame, stored: DataFrame, seq: str = "seq") -> DataFrame:
    """The first row of each URL that isn't stored yet."""
    order = Window.partitionBy("url").orderBy(seq)
    first = rows.where("url IS NOT NULL").withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")
    return first.join(stored.select("url"), "url", "left_anti").select(rows.columns)


def known_urls(rows: DataFrame, stored: DataFrame) -> DataFrame:
    return rows.join(stored.select("url"), "url", "left_semi")


def dropped_names(before: DataFrame, after: DataFrame, reason: str = "not_kept") -> DataFrame:
    """Names of a snapshot whose key is neither kept nor an alias of a kept one."""
    keys = after.select(brand_key("name").alias("_key")).unionByName(after.select(F.explode("aliases").alias("a")).select(brand_key("a").alias("_key")))
    return before.withColumn("_key", brand_key("name")).join(keys.distinct(), "_key", "left_anti").drop("_key").withColumn("reason", F.lit(reason))
