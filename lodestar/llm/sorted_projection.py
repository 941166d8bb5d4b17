"""Near-duplicate vectors by passes over signs of random projections.

In each pass every vector gets a concatenation of random one-bit hashes (the signs
of random projections); the vectors are put in lexicographic order of it and split,
bit by bit, into leaves of bounded size, inside which each pair is compared.  A
vector's leaves tell how likely its links were missed, so passes go on until that is
below a stated chance for every vector; where vectors lie so dense that passes would
cost more, each is compared with each.  Verified pairs are united into components.
Inside a component every pair is then compared, in blocks, because passes see only
some of the links of a dense group.

Vectors of equal content are compared once, whatever their number.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.names import content_name, settle_names
from lodestar.operators.components import connected_components
from lodestar.storage import Scratch

#: Sign bits of a pass's key.
_BITS = 32
#: Rows of one sorted partition, of all of which a task holds the vectors.
_ROWS = 32_768


def rows_of(column: pa.Array) -> list[np.ndarray | None]:
    """The vectors of an Arrow list column as float64 arrays; None for null ones and for null or non-finite components."""
    out: list[np.ndarray | None] = []
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    for scalar in column:
        values = scalar.values
        if values is None or values.null_count:
            out.append(None)
            continue
        x = values.to_numpy(zero_copy_only=False).astype(np.float64)
        out.append(x if np.isfinite(x).all() else None)
    return out


def _content(bits: int):
    """vec_id, node and check (a name of the vector's content, null if it can't link), dim, raw (its components: as floats where these are exact, else as doubles)."""

    def run(batches):
        for batch in batches:
            name, dim, raw = [], [], []
            for x in rows_of(batch.column(1)):
                if x is None or not x.any():
                    name.append((None, None))
                    dim.append(None)
                    raw.append(None)
                    continue
                name.append(content_name(x.tobytes(), bits))
                dim.append(len(x))
                with np.errstate(over="ignore"):
                    short = x.astype(np.float32)
                raw.append((short if (short == x).all() else x).tobytes())
            node, check = ([n[k] for n in name] for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(node, pa.int64()), pa.array(check, pa.int64()), pa.array(dim, pa.int32()), pa.array(raw, pa.binary())], names=["vec_id", "node", "check", "dim", "raw"]
            )

    return run


def _units(raw: list[bytes], dim: int) -> np.ndarray:
    """The directions of vectors, in doubles; each row depends on its own vector alone."""
    m = np.stack([np.frombuffer(x, np.float32 if len(x) == 4 * dim else np.float64).astype(np.float64) for x in raw])
    m /= np.abs(m).max(axis=1, keepdims=True)  # keeps the norm from overflowing
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _near(left: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Which rows have a cosine of at least ``least``: by one product, and by the pair's own sum where rounding could decide, so that a pair is judged alike everywhere."""
    cosine = left @ right.T
    near = cosine >= least
    i, j = np.nonzero(np.abs(cosine - least) < 1e-9)
    for at in range(0, len(i), 1 << 16):
        a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        near[a, b] = (left[a] * right[b]).sum(axis=1) >= least
    return near


def _keyed(passes: int, seed: int):
    """Rows node, dim, raw. A row for each vector and pass: pass, dim, key (sign bits, the first one highest), node, raw."""
    planes: dict[int, np.ndarray] = {}
    weights = 1 << np.arange(_BITS - 1, -1, -1, dtype=np.int64)

    def run(batches):
        for batch in batches:
            nodes, raw = batch.column(0), batch.column(2).to_pylist()
            dims = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int32)
            keys = np.zeros((passes, len(raw)), np.int64)
            for dim in set(dims.tolist()):
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((passes * _BITS, dim))
                at = np.flatnonzero(dims == dim)
                for some in np.array_split(at, -(-len(at) // 1024)):
                    m = _units([raw[i] for i in some.tolist()], dim)
                    for lo in range(0, passes, 64):
                        hi = min(passes, lo + 64)
                        keys[lo:hi, some] = ((m @ planes[dim][lo * _BITS : hi * _BITS].T > 0).reshape(len(some), hi - lo, _BITS) @ weights).T
            for p in range(passes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(raw), p, np.int32)), pa.array(dims), pa.array(keys[p]), nodes, batch.column(2)], names=["pass", "dim", "key", "node", "raw"]
                )

    return run


def _forest(near: np.ndarray) -> tuple[list[int], list[int]]:
    """(row, column) of entries that connect the same rows and columns as all true entries do."""
    a, b = [], []
    rows, columns = near.any(axis=1), np.ones(near.shape[1], bool)
    for start in np.flatnonzero(rows).tolist():
        todo = [start] if rows[start] else []
        rows[start] = False
        while todo:
            i = todo.pop()
            for j in np.flatnonzero(near[i] & columns).tolist():
                columns[j] = False
                a.append(i)
                b.append(j)
                more = np.flatnonzero(near[:, j] & rows).tolist()
                rows[more] = False
                todo += more
                a += more
                b += [j] * len(more)
    return a, b


def _linked(nodes: np.ndarray, others: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i, j = _forest(near)
    a, b = nodes[i], others[j]
    return a[a != b], b[a != b]


def _length(x: np.ndarray) -> np.ndarray:
    """Bits of each number, 0 for 0; exact below 2**53."""
    return np.frexp(x.astype(np.float64))[1]


def _split(keys: np.ndarray, leaf: int):
    """(from, to, depth) of the leaves of sorted keys: halved bit by bit as long as they are larger than ``leaf``."""
    todo = [(0, len(keys), 0)]
    while todo:
        low, high, depth = todo.pop()
        if high - low <= leaf or depth == _BITS:
            yield low, high, depth
            continue
        bit = 1 << (_BITS - 1 - depth)
        mid = low + int(np.searchsorted(keys[low:high] & bit, bit))
        todo += [(x, y, depth + 1) for x, y in ((low, mid), (mid, high)) if y > x]


def _leaves(leaf: int, least: float):
    """One sorted partition: linked pairs (a, b) inside leaves, and for each row (a, gain).

    ``gain`` is -log of the chance that this pass misses a pair at exactly ``least``
    with that row.  It counts the shortest prefix whose rows are all in this partition
    and in one leaf, so that a leaf cut by the partition's ends claims no more than it sees.
    """
    agree = 1 - np.arccos(least) / np.pi

    def out(a, b, gain):
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.nulls(n, pa.int64()) if b is None else pa.array(b, pa.int64()), pa.nulls(n, pa.float64()) if gain is None else pa.array(gain, pa.float64())], names=["a", "b", "gain"]
        )

    def run(batches):
        read = [b for b in batches if b.num_rows]
        if not read:
            return
        rows = pa.Table.from_batches(read)
        which, dims, keys, nodes = (rows.column(i).to_numpy() for i in range(4))
        raw = rows.column(4).to_pylist()
        ends = np.flatnonzero((np.diff(which) != 0) | (np.diff(dims) != 0)) + 1
        for low, high in zip([0, *ends.tolist()], [*ends.tolist(), len(keys)], strict=True):
            k, n = keys[low:high], nodes[low:high]
            # the first and the last rows of the partition may have more of their prefix elsewhere
            shared = np.zeros(high - low, np.int64)
            for end in ([0] if low == 0 else []) + ([-1] if high == len(keys) else []):
                shared = np.maximum(shared, _BITS + 1 - _length(k ^ k[end]))
            depth = np.zeros(high - low, np.int64)
            for x, y, d in _split(k, leaf):
                if y - x > leaf:
                    depth[x:y] = _BITS + 1
                    continue
                depth[x:y] = d
                m = _units(raw[low + x : low + y], int(dims[low]))
                near = _near(m, m, least)
                np.fill_diagonal(near, False)
                some = np.flatnonzero(near.any(axis=1))
                if len(some):
                    near = near[np.ix_(some, some)]
                    np.fill_diagonal(near, True)
                    yield out(*_linked(n[x:y][some], n[x:y][some], near), None)
            depth = np.maximum(depth, shared)
            with np.errstate(divide="ignore"):
                gain = np.minimum(np.where(depth > _BITS, 0.0, -np.log1p(-(agree ** depth))), 1e6)
            yield out(n, None, gain)

    return run


def _groups(batches, width: int, of: int):
    """Rows of sorted batches, a list for each value of their first ``of`` columns."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(width)), strict=True):
            if rows and rows[-1][:of] != row[:of]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _block_pairs(least: float):
    """Rows sorted by dim, i, j: dim, i, j, own, node, raw. Linked pairs between two blocks, or inside one where i = j."""

    def run(batches):
        for rows in _groups(batches, 6, 3):
            dim, i, j, own, nodes, raw = zip(*rows, strict=True)
            m, own, nodes = _units(raw, dim[0]), np.array(own), np.array(nodes)
            left, right = np.flatnonzero(own == i[0]), np.flatnonzero(own == j[0])
            near = _near(m[left], m[right], least)
            if i[0] == j[0]:
                np.fill_diagonal(near, True)
            a, b = _linked(nodes[left], nodes[right], near)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _every_pair(rest: DataFrame, n: int, block: int, least: float) -> DataFrame:
    """Linked pairs (a, b) of n vectors, each compared with each."""
    blocks = max(1, -(-n // block))
    own = rest.select("dim", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("own"), "node", "raw")
    spread = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    spread = spread.select("dim", F.least("own", "other").cast("int").alias("i"), F.greatest("own", "other").cast("int").alias("j"), "own", "node", "raw")
    dealt = spread.repartition("dim", "i", "j").sortWithinPartitions("dim", "i", "j")
    return dealt.mapInArrow(_block_pairs(least), "a long, b long")


def _linked_pairs(distinct: DataFrame, scratch: Scratch, least: float, miss: float, leaf: int, exhaustive: int, seed: int) -> DataFrame:
    """Linked pairs (a, b) that connect what all links connect, but for a link at ``least`` with an estimated chance of at most ``miss``.

    Rounds of passes, as many as the counted vectors need at their expected depth; a
    vector is done once its own leaves were shallow enough for ``miss``.  What is left,
    in dense places, goes through further rounds as long as these cost less than
    comparing each with each, which is what happens to the rest.
    """
    rest, n, found = distinct, distinct.count(), []
    need, agree = -math.log(miss), 1 - math.acos(least) / math.pi
    gain = -math.log1p(-(agree ** max(1, math.ceil(math.log2(max(n, 2) / leaf)))))
    lacking = need
    while n > exhaustive:
        passes = math.ceil(1.15 * lacking / gain)
        if passes * leaf >= n * 2:  # blocks of each with each then deal fewer rows
            break
        keyed = rest.select("node", "dim", "raw").mapInArrow(_keyed(passes, seed + len(found)), "pass int, dim int, key long, node long, raw binary")
        ordered = keyed.repartitionByRange(max(1, -(-n * passes // _ROWS)), "pass", "dim", "key", "node").sortWithinPartitions("pass", "dim", "key", "node")
        seen = scratch.save(ordered.mapInArrow(_leaves(leaf, least), "a long, b long, gain double"), "seen")
        found.append(seen.where("b IS NOT NULL").select("a", "b"))
        gains = seen.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("gain").alias("gain"))
        if "lacking" not in rest.columns:
            rest = rest.withColumn("lacking", F.lit(need))
        left = rest.join(gains, "node").withColumn("lacking", F.col("lacking") - F.col("gain")).where("lacking > 0")
        rest = scratch.save(left.select("node", "dim", "raw", "lacking", (F.col("gain") / passes).alias("each")), "rest")
        n, lacking, gain = rest.agg(F.count("*"), F.max("lacking"), F.percentile_approx("each", 0.1)).first()
        rest = rest.drop("each")
        if not n or not gain:
            break
    if n:
        found.append(_every_pair(rest.select("node", "dim", "raw"), n, leaf, least))
    return functools.reduce(DataFrame.unionByName, found) if found else distinct.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)


def _block_counts(least: float):
    """Rows sorted by g: g, own, i, j, node, copies, dim, raw. For each row the number of vectors that it links with in the other block (in its own where i = j)."""

    def run(batches):
        for rows in _groups(batches, 8, 1):
            _, own, i, j, nodes, copies, dim, raw = zip(*rows, strict=True)
            m, own, copies = _units(raw, dim[0]), np.array(own), np.array(copies)
            left, right = np.flatnonzero(own == i[0]), np.flatnonzero(own == j[0])
            out = np.zeros(len(nodes), np.int64)
            for at in range(0, len(left), 1024):
                some = left[at : at + 1024]
                near = _near(m[some], m[right], least)
                if i[0] == j[0]:
                    near[np.arange(len(some)), np.arange(at, at + len(some))] = False
                else:
                    out[right] += near.T @ copies[some]
                out[some] += near @ copies[right]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(out, pa.int64())], names=["node", "links"])

    return run


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9, miss: float = 1e-4, leaf: int = 1024, exhaustive: int = 4096, block: int = 512, seed: int = 5, name_bits: int = 64
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of ``vectors``.

    A link joins two vectors of equal length whose cosine, in double precision, is at
    least ``least``; ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable.  Vectors that are null, empty,
    zero or hold null or non-finite components link with nothing.  Rows of equal
    content (by 128 bits of a digest) are copies of each other and link; so do repeated
    rows.  A row with a null id takes part, stays null, and names a component only if
    no other can.  Up to ``exhaustive`` different vectors are compared each with each;
    of more, as many passes run as make the estimated chance of missing a link at
    exactly ``least`` at most ``miss``.  Inside a component of m vectors blocks of
    ``block``, or of 8 sqrt(m) up to 8192 where that is more, are compared.
    Columns other than the two named are ignored; ``name_bits`` below 64 is for tests.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "projection")
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    read = scratch.save(source.mapInArrow(_content(name_bits), "vec_id long, node long, check long, dim int, raw binary"), "rows")
    rows, _ = settle_names(read, scratch)
    per = rows.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"), F.min("vec_id").alias("lowest"))
    distinct = rows.where("node IS NOT NULL").dropDuplicates(["node"]).select("node", "dim", "raw")
    distinct = scratch.save(distinct, "distinct")
    pairs = _linked_pairs(distinct, scratch, least, miss, leaf, exhaustive, seed)
    labels = scratch.save(connected_components(pairs, "a", "b", scratch=scratch), "labels")
    # every pair of blocks of a component, so that each link counts
    sized = labels.join(labels.groupBy("component").agg(F.count("*").alias("members")), "component")
    sized = sized.withColumn("blocks", F.ceil(F.col("members") / F.greatest(F.lit(block), F.least(F.lit(8192), 8 * F.sqrt("members")))).cast("int"))
    sized = sized.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    member = sized.join(distinct, "node").join(per.select("node", "copies"), "node")
    spread = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    grouped = spread.select(F.xxhash64("component", "i", "j").alias("g"), "own", "i", "j", "node", "copies", "dim", "raw").repartition("g").sortWithinPartitions("g", "own", "node")
    links = grouped.mapInArrow(_block_counts(least), "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    classes = per.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")).join(links, "node", "left")
    lowest = classes.groupBy("component").agg(F.min("lowest").alias("component_id"))
    classes = classes.join(lowest, "component").select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.select("vec_id", "node").join(classes, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
    out = scratch.save(out, "out")
    scratch.clear(out)
    return out
