"""Model-backed steps behind one interface, with a default that needs no model.

A provider's methods take and return Columns, so the default ones stay visible to
Catalyst; one that calls a service would return pandas UDFs over the same columns.
"""

from __future__ import annotations

import hashlib
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.functions.specs import parse_line
from lodestar.functions.text import edit_similarity

MODEL_PATTERN = r"\b[A-Z]{2,}[0-9]{2,}[A-Z0-9\-]*\b"
SERIES_PATTERN = r"\b([A-Z][A-Za-z0-9\-]{1,30}) [Ss]eries\b"


class Provider(Protocol):
    def judge_alias(self, core1: Column, core2: Column) -> Column: ...

    def brands(self, text: Column) -> Column: ...

    def series(self, text: Column) -> Column: ...

    def models(self, text: Column) -> Column: ...

    def specs(self, text: Column) -> Column: ...

    def embed(self, text: Column) -> Column: ...

    def infer_brand(self, entity: Column, neighbours: Column) -> Column: ...


class RuleProvider:
    """Deterministic answers by rule: likeness for aliases, patterns for names, hashed words for vectors."""

    def __init__(self, known_brands: list[str] | None = None, dimension: int = 64, similar: float = 0.82):
        self.known_brands, self.dimension, self.similar = known_brands or [], dimension, similar

    def judge_alias(self, core1: Column, core2: Column) -> Column:
        score = edit_similarity(core1, core2)
        inside = F.contains(core1, core2) | F.contains(core2, core1)
        return F.struct(F.lit("model_rule").alias("method"), (inside | (score >= self.similar)).alias("is_alias"), F.when(F.length(core1) <= F.length(core2), core1).otherwise(core2).alias("canonical"), F.greatest(score, F.when(inside, 0.8).otherwise(0.0)).alias("confidence"))

    def brands(self, text: Column) -> Column:
        found = [F.when(F.contains(F.lower(text), F.lit(b.lower())), F.lit(b)) for b in self.known_brands]
        return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")

    def series(self, text: Column) -> Column:
        return F.array_distinct(F.regexp_extract_all(text, F.lit(SERIES_PATTERN), F.lit(1)))

    def models(self, text: Column) -> Column:
        return F.array_distinct(F.regexp_extract_all(text, F.lit(MODEL_PATTERN), F.lit(0)))

    def specs(self, text: Column) -> Column:
        return F.filter(F.transform(F.split(text, "\n"), lambda line: parse_line(line)), lambda s: s.isNotNull())

    def infer_brand(self, entity: Column, neighbours: Column) -> Column:
        """The first of the neighbours' brands that the entity's text names, and how sure; null if it names none."""
        named = F.get(F.filter(neighbours, lambda b: F.contains(F.lower(entity), F.lower(b))), F.lit(0))
        return F.struct(named.alias("brand"), F.when(named.isNotNull(), 0.9).otherwise(0.0).alias("confidence"))

    def embed(self, text: Column) -> Column:
        size = self.dimension

        @F.pandas_udf("array<float>")
        def vectors(texts: pd.Series) -> pd.Series:
            return texts.map(lambda t: hashed_words(t or "", size))

        return vectors(text)


def hashed_words(text: str, size: int) -> list[float]:
    """A unit vector of signed word counts, by hash."""
    out = np.zeros(size)
    for word in text.lower().split():
        h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")
        out[h % size] += 1 if h >> 63 else -1
    norm = np.linalg.norm(out)
    return (out / norm if norm else out).astype(np.float32).tolist()
