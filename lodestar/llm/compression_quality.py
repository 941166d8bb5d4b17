"""A text-quality score from compression.

One zstandard dictionary is built from texts labelled good and one from texts
labelled bad.  A document is compressed with each, in blocks small enough for the
dictionary to matter throughout; the difference of the two sizes, divided by the
length, tells which of the two it resembles.  A logistic curve, fitted on other
labelled documents, turns the difference into a probability, given how well the
text compresses at all and how long it is.

The dictionaries and the curve are fitted on bounded samples (``dictionary_docs``
and ``calibration_docs`` documents of each label, in the order of a hash of the id).
Of a dictionary document, ``sample_blocks`` blocks count, spread evenly over the
whole text; the curve is fitted on whole texts, whose features are taken where the
rows are.  Every document is scored, whole.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 1024
LEVEL = 1
FRAME = 6  # bytes of every compressed block that don't depend on its content


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries of bad and good texts and the logistic curve over :func:`features`."""

    bad: bytes
    good: bytes
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]  # the first one stands alone

    def score(self, text: str | None) -> float:
        x = (np.array(features(text or "", *_compressors(self.bad, self.good))) - self.centre) / self.scale
        z = self.weights[0] + float(x @ np.array(self.weights[1:]))
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


@lru_cache(maxsize=2)
def _compressors(bad: bytes, good: bytes):
    import zstandard

    def one(content: bytes):
        kind = zstandard.DICT_TYPE_FULLDICT if content[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
        data = zstandard.ZstdCompressionDict(content, dict_type=kind)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)

    return one(bad), one(good)


def blocks(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return [raw[at : at + BLOCK] for at in range(0, len(raw), BLOCK)]


def features(text: str, bad, good) -> tuple[float, float, float]:
    """Size difference by length (above 0: the good dictionary fits better), log of the compression ratio, log of the length."""
    n, with_bad, with_good = 0, 0, 0
    for block in blocks(text):
        n += len(block)
        with_bad += len(bad.compress(block)) - FRAME
        with_good += len(good.compress(block)) - FRAME
    return (with_bad - with_good) / (n + 16), math.log((with_good + 1) / (n + 1) + 0.01), math.log(n + 1)


def spread_blocks(text: str, most: int) -> list[bytes]:
    """At most so many blocks of the text, evenly spread over the whole of it."""
    found = blocks(text)
    return found if len(found) <= most else [found[k * len(found) // most] for k in range(most)]


def build_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; of too few samples to train on, their last bytes."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or b"\n"


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, scale and weights by Newton's method."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - centre) / scale]
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-10:
            break
    return centre, scale, w


def is_held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2, F.lit(False))


def _sampled(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """(label, doc_id, text) of picked ids, one text for each: of an id with several texts, the smallest.

    ``picked`` has a bounded number of rows, so it may be broadcast and the grouping is small, however often an id comes.
    """
    return docs.join(F.broadcast(picked), "doc_id").groupBy("label", "doc_id").agg(F.min("text").alias("text"))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    dictionary_docs: int = 2000, calibration_docs: int = 4000, dictionary_size: int = 1 << 17, sample_blocks: int = 32,
) -> QualityModel:
    """Learn from labelled rows outside the held-out part.

    Documents with contradicting labels, labels other than 0 and 1, null ids and empty
    texts teach nothing; of an id that comes with several texts, the smallest one does.
    With fewer than two labels to learn from, the score of every document is the share
    of label 1 (a half, if there is no label).  The driver gets at most
    2 x ``dictionary_docs`` x ``sample_blocks`` blocks of 1 KB and 2 x ``calibration_docs``
    rows of three numbers.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    known = known.where(~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text <> ''")
    ranked = [known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(dictionary_docs + calibration_docs).select("doc_id", "label").collect() for label in (0, 1)]
    spark, kind = docs.sparkSession, f"doc_id {labels.schema[id_col].dataType.simpleString()}, label int"
    # of few labelled rows, half teach the dictionaries and the others the curve
    cut = [min(dictionary_docs, (len(rows) + 1) // 2) for rows in ranked]
    first = spark.createDataFrame([r for rows, n in zip(ranked, cut, strict=True) for r in rows[:n]], kind)
    rest = spark.createDataFrame([r for rows, n in zip(ranked, cut, strict=True) for r in rows[n:] or rows], kind)

    def pieces(batches):
        for batch in batches:
            found = [spread_blocks(text, sample_blocks) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.string()), pa.array(found, pa.list_(pa.binary()))], names=["label", "doc_id", "blocks"])

    sample = _sampled(texts, first).mapInArrow(pieces, "label int, doc_id string, blocks array<binary>").collect()
    sample.sort(key=lambda r: (zlib.crc32(f"order {r.doc_id}".encode()), r.doc_id))
    by_label = {label: [bytes(b) for r in sample if r.label == label for b in r.blocks] for label in (0, 1)}
    if not by_label[0] or not by_label[1]:
        counts = [sum(r.label == label for r in sample) for label in (0, 1)]
        share = min(max(counts[1] / sum(counts), 1e-6), 1 - 1e-6) if sample else 0.5
        return QualityModel(b"\n", b"\n", (0.0,) * 3, (1.0,) * 3, (math.log(share / (1 - share)), 0.0, 0.0, 0.0))
    bad, good = (build_dictionary(by_label[label], dictionary_size) for label in (0, 1))

    def measured(batches):
        pair = _compressors(bad, good)
        for batch in batches:
            found = np.array([features(text, *pair) for text in batch.column(2).to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.string()), *(pa.array(found[:, k]) for k in range(3))], names=["label", "doc_id", "x0", "x1", "x2"])

    measure = lambda picked: sorted(tuple(r) for r in _sampled(texts, picked).mapInArrow(measured, "label int, doc_id string, x0 double, x1 double, x2 double").collect())
    seen = measure(rest)
    if len({r[0] for r in seen}) < 2:  # the curve's documents of a label are missing or empty
        seen = measure(rest.unionByName(first))
    centre, scale, weights = fit_logistic(np.array([r[2:] for r in seen]), np.array([r[0] for r in seen], float))
    return QualityModel(bad, good, tuple(centre), tuple(scale), tuple(weights))


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", accept: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row; a null text counts as empty, other columns are ignored."""

    def run(batches):
        for batch in batches:
            found = [model.score(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64()), pa.array([int(s >= accept) for s in found], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    source = docs.select(F.col(id_col).alias("doc_id"), is_held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text", accept: float = 0.7) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the model accepts."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            keep = [model.score(text) >= accept for text in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
