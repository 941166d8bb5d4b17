"""Cost-balanced packing of tokenised documents into sequences of fixed length.

A document costs a linear term and a quadratic one, as attention does.  Within a
window of documents, whole sequences are cut off first; what is left of each
document is placed in descending order into the sequence of lowest cost that has
room for it, and cut only where none has.  The rest that fills no sequence goes to
sequences whose lengths are powers of two, which need no padding.

Tokenising and packing happen where the rows are read; nothing is shuffled.  A
window holds a bounded number of tokens, whatever the size of the input.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.bpe_pieces import byte_characters
from lodestar.session import ship_file

WINDOW_TOKENS = 1 << 22


class VocabularyEncoder:
    """The ids that ``tokenizers`` gives for a byte-level BPE file, by a faster merge loop over the same vocabulary.

    The ids of such a vocabulary are its merge ranks.  A text that holds one of the
    added tokens' strings goes to ``tokenizers`` itself.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token["content"] for token in spec.get("added_tokens", [])]
        back = {c: b for b, c in enumerate(byte_characters())}
        ranks = {bytes(back[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in self.added}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if any(a in text for a in self.added):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> VocabularyEncoder:
    return VocabularyEncoder(path, pattern)


def document_cost(tokens: np.ndarray, linear: float, quadratic: float) -> np.ndarray:
    """Estimated cost of attending within one piece of each of these lengths."""
    tokens = tokens.astype(np.float64)
    return linear * tokens + quadratic * tokens * tokens


def pack_window(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> np.ndarray:
    """Pieces that cover every token of a window once: rows of document, start, length, sequence, offset."""
    whole = lengths // capacity
    doc = np.repeat(np.arange(len(lengths)), whole)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)) * capacity
    sequence = len(doc)
    full = np.full(sequence, capacity)
    pieces = [np.stack([doc, start, full, np.arange(sequence), np.zeros(sequence, np.int64)], axis=1)]
    rest = lengths % capacity
    total = int(rest.sum())
    if not total:
        return pieces[0]
    sizes = [capacity] * (total // capacity)
    sizes += [1 << bit for bit in range(capacity.bit_length() - 1, -1, -1) if total % capacity >> bit & 1]
    room, used, cost = np.array(sizes), np.zeros(len(sizes), np.int64), np.zeros(len(sizes))
    order = np.argsort(-rest, kind="stable")
    order = order[: np.count_nonzero(rest)]
    for group in np.split(order, np.flatnonzero(np.diff(rest[order])) + 1):
        # documents of one remainder go one by one to the cheapest sequence with room; as each adds the same
        # cost, these are the cheapest of all places that the sequences have for this remainder
        size = int(rest[group[0]])
        step = float(document_cost(np.array(size), linear, quadratic))
        places = np.minimum(room // size, len(group))
        at = np.repeat(np.arange(len(sizes)), places)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(places) - places, places)
        first = np.lexsort((at, cost[at] + nth * step))[: len(group)]
        at, nth = at[first], nth[first]
        placed = group[: len(at)]
        pieces.append(np.stack([placed, lengths[placed] - size, np.full(len(at), size), sequence + at, used[at] + nth * size], axis=1))
        taken = np.bincount(at, minlength=len(sizes))
        room -= taken * size
        used += taken * size
        cost += taken * step
        for one in group[len(at) :].tolist():  # no sequence has room for the whole; each cut fills one up
            begin, left = int(lengths[one]) - size, size
            while left:
                fits = room >= left
                if not fits.any():
                    fits = room > 0
                k = int(np.argmin(np.where(fits, cost, np.inf)))
                take = min(left, int(room[k]))
                pieces.append(np.array([[one, begin, take, sequence + k, used[k]]]))
                room[k] -= take
                used[k] += take
                cost[k] += float(document_cost(np.array(take), linear, quadratic))
                begin, left = begin + take, left - take
    return np.concatenate(pieces)


_SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 0,
    linear: float = 1.0,
    quadratic: float = 1.0 / 1024,
    window_tokens: int = WINDOW_TOKENS,
    with_ids: bool = True,
) -> DataFrame:
    """One row for each piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    Each document is its ids followed by ``end_id``; a null or empty text is that id
    alone.  Each id is in exactly one piece, the pieces of a sequence follow each other
    from offset 0, and a sequence holds ``capacity`` ids or a power of two of them.
    Repeated rows are packed as often as they come; a null id stays null.  Columns
    other than the two named are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    shipped = ship_file(docs.sparkSession, tokenizer_path)

    def run(batches):
        encode = encoder(SparkFiles.get(shipped), pattern)
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        names, tokens, held, sequences = [], [], 0, 0

        def flush():
            nonlocal names, tokens, held, sequences
            lengths = np.array([len(t) for t in tokens], np.int64)
            pieces = pack_window(lengths, capacity, linear, quadratic)
            doc, start, length, sequence, offset = (np.ascontiguousarray(x, np.int64) for x in pieces.T)
            cut = [tokens[d][s : s + n] for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
            columns = [
                pa.array([names[d] for d in doc.tolist()], docs_type),
                *(pa.array(x) for x in (start, length)),
                pa.array([zlib.crc32(x.tobytes()) for x in cut], pa.int64()),
                *(pa.array(x) for x in (lengths[doc], sequence + sequences + base, offset)),
            ]
            labels = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array([x.astype(np.int32) for x in cut], pa.list_(pa.int32())))
                labels.append("ids")
            sequences += int(sequence.max()) + 1
            names, tokens, held = [], [], 0
            return pa.RecordBatch.from_arrays(columns, names=labels)

        docs_type = None
        for batch in batches:
            docs_type = batch.column(0).type
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "")
                ids.append(end_id)
                names.append(name)
                tokens.append(np.array(ids, "<u4"))
                held += len(ids)
                if held >= window_tokens:
                    yield flush()
        if names:
            yield flush()

    schema = f"doc_id {kind}, {_SCHEMA}" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
