"""Near-duplicate documents by a chosen-path set similarity join.

Documents with equal shingle sets are one class from the start.  Each class has a
minwise signature.  Independent trees branch the classes: at a node, a hash of the
node's path picks which signature coordinates to look at, and a class goes to the
child named by the minwise token it holds there.  Two classes of similarity s meet
in a given child with probability s, so near pairs stay together while the rest
part ways.

* A node whose members already lie in one component is finished.
* A node of at most ``leaf`` members is compared exhaustively by signature.
* A larger node first links its members to a few pivots (every third level).  If few members are then
  outside its largest component, those are compared with all; else it branches
  again.  A child with two thirds of its parent's members or more is too dense for
  branching to part it, and is compared exhaustively in blocks; all others shrink
  from level to level, so there are about log(members) of these.  No node is capped
  or dropped.

Signatures only propose pairs (far below the threshold, so that a true pair is not
lost); each link is confirmed on the full sets.  Short sets travel with their
signatures, so that a node confirms its own pairs and emits a spanning forest of
true links; pairs with a longer set are proposed as a forest first and, in a second
pass, whatever could still join two components: as pairs where these are few, else
as members, whose full sets are sent to the node once and compared there.  So what
is sent follows the number of members and not its square.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.names import content_name, rename, settle_names
from lodestar.llm.shingles import minwise, overlap, pack, shingle_set, signature_seeds, unpack
from lodestar.operators.components import connected_components
from lodestar.operators.sieve import maybe_among
from lodestar.storage import Scratch

#: Coordinates that trees branch on; the signature of a long set has more of them, which only comparisons use.
SIGNATURE = 64
LONG_SIGNATURE = 256


#: Shingles up to which a set travels with its signature.
SHORT = 192
#: Bytes of full sets that make a block of a dense node, and entries of sets that are counted at a time.
_BLOCK_BYTES = 32 << 20
_ENTRIES = 1 << 21


def _sketches(width: int, bits: int):
    def run(batches):
        seeds = signature_seeds(LONG_SIGNATURE)
        few = tuple(x[:SIGNATURE] for x in seeds)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            count, name, sig, short = [], [], [], []
            for text in texts:
                hashes = shingle_set(text, width)
                count.append(len(hashes))
                name.append(content_name(hashes.tobytes(), bits) if len(hashes) else (None, None))
                sig.append(minwise(hashes, few if len(hashes) <= SHORT else seeds).tobytes() if len(hashes) else None)
                short.append(pack(hashes) if 0 < len(hashes) <= SHORT else None)
            node, check = ([n[k] for n in name] for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(count, pa.int64()), pa.array(node, pa.int64()), pa.array(check, pa.int64()), pa.array(sig, pa.binary()), pa.array(short, pa.binary())],
                names=["doc_id", "n_shingles", "node", "check", "sig", "short"],
            )

    return run


def _full_sets(width: int, bits: int):
    def run(batches):
        for batch in batches:
            name, count, packed = [], [], []
            for text in batch.column(0).to_pylist():
                hashes = shingle_set(text, width)
                if len(hashes):
                    name.append(content_name(hashes.tobytes(), bits))
                    count.append(len(hashes))
                    packed.append(pack(hashes))
            node, check = ([n[k] for n in name] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(check, pa.int64()), pa.array(count, pa.int64()), pa.array(packed, pa.binary())], names=["node", "check", "n_shingles", "packed"])

    return run


def _least(percent: int, size: int) -> int:
    """Agreeing coordinates of ``size`` that a linked pair has but for some four standard deviations."""
    return max(1, int(size * percent / 100 - 4 * (size * percent * (100 - percent)) ** 0.5 / 100))


def _resemble(percent: int, a: bytes, b: bytes) -> bool:
    size = min(len(a), len(b)) // 4
    return bool((np.frombuffer(a, np.int32, size) == np.frombuffer(b, np.int32, size)).sum() >= _least(percent, size))


def _linked(percent: int, na: int, nb: int, both: int) -> bool:
    return 100 * both >= percent * (na + nb - both)


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            keep = [_linked(percent, na, nb, overlap(a, b)) for na, nb, a, b in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keep, pa.bool_())], names=["a", "b", "linked"])

    return run


def _proposal(a, b, linked) -> pa.RecordBatch:
    """Pairs; linked is true where the full sets have confirmed it and null where they are still to be compared."""
    a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])


def _to_pivots(percent: int):
    """Rows: node, n_shingles, sig, short, and the same four of a pivot."""

    def run(batches):
        for batch in batches:
            a, b, linked = [], [], []
            for x, nx, sx, fx, y, ny, sy, fy in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                if 100 * min(nx, ny) < percent * max(nx, ny) or not _resemble(percent, sx, sy):
                    continue
                exact = fx is not None and fy is not None
                if not exact or _linked(percent, nx, ny, overlap(fx, fy)):
                    a.append(x)
                    b.append(y)
                    linked.append(True if exact else None)
            yield _proposal(a, b, linked)

    return run


class _Union:
    """Union-find over small dense indices."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y


def _alike(sigs: np.ndarray, sizes: np.ndarray, labels: np.ndarray, percent: int, least: int, rows: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i in rows, j > i) of different labels that agree in enough coordinates and have sizes that allow a link."""
    agree = (sigs[rows, None, :] == sigs[None, :, :]).sum(axis=2)
    own = np.arange(len(sigs))[rows]
    smaller = np.minimum(sizes[rows, None], sizes[None, :])
    larger = np.maximum(sizes[rows, None], sizes[None, :])
    ok = (agree >= least) & (labels[rows, None] != labels[None, :]) & (100 * smaller >= percent * larger) & (own[:, None] < np.arange(len(sigs))[None, :])
    i, j = np.nonzero(ok)
    return own[i], j, agree[i, j]


def _common(sets: list[bytes], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets i and j, pair by pair or, for many pairs, of all sets at once."""
    if len(i) <= 2 * len(sets):
        return np.array([overlap(sets[x], sets[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
    parts = [unpack(x) for x in sets]
    ranges = max(1, -(-sum(map(len, parts)) // _ENTRIES))  # of values, so that a bounded number is held at a time
    edges = np.linspace(0, 1 << 48, ranges + 1).astype(np.uint64)
    cuts = [np.searchsorted(x, edges) for x in parts]
    total = np.zeros((len(parts), len(parts)), np.int64)
    for r in range(ranges):
        _count_common([x[c[r] : c[r + 1]] for x, c in zip(parts, cuts, strict=True)], total)
    return total[i, j]


def _count_common(parts: list[np.ndarray], total: np.ndarray) -> None:
    """Add the number of values that each two sets share: pair by pair for values of few sets, by products of membership matrices for the others."""
    m = len(parts)
    owner = np.repeat(np.arange(m), [len(x) for x in parts])
    values = np.concatenate(parts)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    runs = np.diff(np.append(starts, len(values)))
    rare = np.repeat(runs <= 8, runs)
    few, of = values[rare], owner[rare]
    for d in range(1, 8):
        same = np.flatnonzero(few[d:] == few[:-d])
        if not len(same):
            break
        both = np.bincount(of[same] * m + of[same + d], minlength=m * m).reshape(m, m)
        total += both + both.T
    place = np.repeat(np.cumsum(runs > 8) - 1, runs)[~rare]
    of = owner[~rare]
    cuts = np.searchsorted(place, np.arange(0, (place[-1] + 1 if len(place) else 0) + 4096, 4096))
    for lo, hi, first in zip(cuts, cuts[1:], range(0, 1 << 62, 4096), strict=False):
        member = np.zeros((m, int(place[hi - 1]) - first + 1), np.float32)
        member[of[lo:hi], place[lo:hi] - first] = 1
        total += (member @ member.T).astype(np.int64)


class _Group:
    """The rows of one group: which pairs could be links by signature and size."""

    def __init__(self, percent: int, nodes, labels, sizes, sigs: list[bytes], has_short: np.ndarray):
        self.nodes, self.labels, self.sizes = nodes, labels, sizes
        head = np.frombuffer(b"".join([x[: 4 * SIGNATURE] for x in sigs]), np.int32).reshape(len(sigs), -1)
        found = [_alike(head, sizes, labels, percent, _least(percent, SIGNATURE), slice(at, at + 64)) for at in range(0, len(nodes), 64)]
        i, j, agree = (np.concatenate(x) for x in zip(*found, strict=True))
        long = np.array([len(x) == 4 * LONG_SIGNATURE for x in sigs])
        if long.any():
            row = np.cumsum(long) - 1
            whole = np.frombuffer(b"".join([x for x in sigs if len(x) == 4 * LONG_SIGNATURE]), np.int32).reshape(-1, LONG_SIGNATURE)
            fits = ~(long[i] & long[j])
            both = np.flatnonzero(~fits)
            for at in range(0, len(both), 4096):
                some = both[at : at + 4096]
                fits[some] = (whole[row[i[some]]] == whole[row[j[some]]]).sum(axis=1) >= _least(percent, LONG_SIGNATURE)
            i, j, agree = i[fits], j[fits], agree[fits]
        self.i, self.j, self.agree = i, j, agree
        self.exact = has_short[i] & has_short[j]

    def confirmed(self, percent: int, sets: list[bytes | None], some: np.ndarray) -> np.ndarray:
        """Which of these pairs are links, by their full sets."""
        i, j = self.i[some], self.j[some]
        used, at = np.unique(np.concatenate((i, j)), return_inverse=True)
        both = _common([sets[k] for k in used.tolist()], at[: len(i)], at[len(i) :])
        return 100 * both >= percent * (self.sizes[i] + self.sizes[j] - both)

    def forest(self, order: list[int]) -> list[int]:
        """Of the pairs in this order those that join what the ones before, and equal labels, leave apart."""
        parts = _Union(len(self.nodes))
        first: dict[int, int] = {}
        for k, label in enumerate(self.labels.tolist()):
            parts.join(first.setdefault(label, k), k)
        return [k for k in order if parts.join(int(self.i[k]), int(self.j[k]))]


def _per_group(flush, columns: int):
    """Runs ``flush`` on the rows of each group: numbers group, node, label, n_shingles, then ``columns`` of bytes. The input is sorted by group."""

    def whole(group, rows):
        parts = list(zip(*rows, strict=True))
        return flush(int(group), *(np.concatenate(x) for x in parts[:3]), *([y for part in x for y in part] for x in parts[3:]))

    def run(batches):
        current, rows = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column(0).to_numpy(zero_copy_only=False)
            numbers = [batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3)]
            held = [batch.column(4 + i).to_pylist() for i in range(columns)]
            cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if group[lo] != current and rows:
                    yield whole(current, rows)
                    rows = []
                current = group[lo]
                rows.append(tuple(x[lo:hi] for x in (*numbers, *held)))
        if rows:
            yield whole(current, rows)

    return run


def _compare(percent: int):
    """Rows: group, node, label, n_shingles, sig, short. A forest of confirmed links and, between what these leave apart, of proposals."""

    def flush(_, nodes, labels, sizes, sigs, short):
        group = _Group(percent, nodes, labels, sizes, sigs, np.array([x is not None for x in short]))
        if not len(group.i):
            return _proposal([], [], [])
        true = np.zeros(len(group.i), bool)
        true[group.exact] = group.confirmed(percent, short, group.exact) if group.exact.any() else False
        order = np.lexsort((-group.agree, ~true))
        pick = group.forest([k for k in order.tolist() if true[k] or not group.exact[k]])
        return _proposal(nodes[group.i[pick]], nodes[group.j[pick]], [True if true[k] else None for k in pick])

    return _per_group(flush, 2)


_OPEN_PAIRS = "g long, a long, b long"


def _still_open(percent: int):
    """The same rows. The pairs that only full sets can decide, or the members of these (b null) where the pairs are many."""

    def flush(g, nodes, labels, sizes, sigs, short):
        group = _Group(percent, nodes, labels, sizes, sigs, np.array([x is not None for x in short]))
        i, j = group.i[~group.exact], group.j[~group.exact]
        if len(i) <= 2 * len(nodes):
            a, b = nodes[i], nodes[j]
            a, b = pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())
        else:
            a = pa.array(nodes[np.unique(np.concatenate((i, j)))], pa.int64())
            b = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), g, np.int64)), a, b], names=["g", "a", "b"])

    return _per_group(flush, 2)


def _decide(percent: int):
    """Rows: group, node, label, n_shingles, sig, short, packed. A forest of links among pairs that hold a longer set."""

    def flush(_, nodes, labels, sizes, sigs, short, packed):
        group = _Group(percent, nodes, labels, sizes, sigs, np.array([x is not None for x in short]))
        some = np.flatnonzero(~group.exact)
        if len(some):
            some = some[group.confirmed(percent, packed, some)]
        pick = group.forest(some[np.argsort(-group.agree[some], kind="stable")].tolist())
        return _proposal(nodes[group.i[pick]], nodes[group.j[pick]], [True] * len(pick))

    return _per_group(flush, 3)


_PAIRS = "a long, b long, linked boolean"


class ChosenPathJoin:
    """One run of the join over one table; see :func:`near_duplicates`."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, percent: int, width: int, trees: int, branches: int, leaf: int, depth: int | None, pivots: int, block_bytes: int, name_bits: int):
        self.spark, self.scratch = docs.sparkSession, Scratch(docs.sparkSession, "chosenpath")
        self.percent, self.width, self.trees, self.branches = percent, width, trees, branches
        self.leaf, self.depth, self.pivots, self.block_bytes, self.name_bits = leaf, depth, pivots, block_bytes, name_bits
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        sketched = self.docs.mapInArrow(_sketches(width, name_bits), "doc_id long, n_shingles long, node long, check long, sig binary, short binary")
        self.rows, self.renamings = settle_names(self.scratch.save(sketched, "rows"), self.scratch)
        self.classes: DataFrame | None = None  # of the classes that share a node with another one
        self.sets: DataFrame | None = None
        self.proposed: DataFrame | None = None
        self.labels: DataFrame | None = None

    def _children(self, frontier: DataFrame) -> DataFrame:
        """frontier: path, node, sig, members. The paths of the coordinates that the path's hash picks; ``was`` is the parent's members."""
        start = F.pmod(F.xxhash64("path"), F.lit(SIGNATURE)).cast("int")
        at = [F.pmod(start + F.lit(j * (SIGNATURE // self.branches)), F.lit(SIGNATURE)) for j in range(self.branches)]
        paths = F.array(*(F.xxhash64("path", x, F.substring("sig", 4 * x + 1, F.lit(4))) for x in at))
        return frontier.select("node", F.explode(paths).alias("path"), F.col("members").alias("was"))

    def _open(self, rows: DataFrame) -> DataFrame:
        """Rows (path, node, label) of nodes that hold more than one component, with the number of members (and ``was``, if given)."""
        label = F.col("node")
        if self.labels is not None:
            rows = rows.join(self.labels, "node", "left")
            label = F.coalesce("component", "node")
        was = [c for c in ("was",) if c in rows.columns]
        rows = rows.select("path", "node", label.alias("label"), *was)
        per = rows.groupBy("path").agg(F.count("*").alias("members"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        return rows.join(per.where("lo < hi").select("path", "members"), "path")

    def _prepare(self, level: DataFrame) -> None:
        """What later steps read of the classes in open nodes: signatures and short sets, and full sets where these are long.

        Long sets are made anew from the texts.  A bitmap of fixed size over the ids
        says which texts to take; the few that it takes in vain do no harm.
        """
        wanted = level.select("node").distinct()
        one = self.rows.select("node", "doc_id", "n_shingles", "sig", "short").join(wanted, "node", "left_semi").dropDuplicates(["node"])
        self.classes = self.scratch.save(one, "classes")
        texts = maybe_among(self.docs, "doc_id", self.classes.where("short IS NULL").select("doc_id"))
        full = texts.select("text").mapInArrow(_full_sets(self.width, self.name_bits), "node long, check long, n_shingles long, packed binary")
        for renamed in self.renamings:
            full = rename(full, renamed)
        self.sets = self.scratch.save(full.drop("check"), "sets")

    def _link(self, pairs: DataFrame, name: str) -> None:
        """Confirm what is still only proposed, and bring the labels up to date."""
        pairs = self.scratch.save(pairs, name)
        fresh = pairs.where("linked IS NULL").select("a", "b").distinct()
        if self.proposed is not None:
            fresh = fresh.join(self.proposed.select("a", "b"), ["a", "b"], "left_anti")
        fresh = self.scratch.save(fresh, "fresh")
        short = self.classes.where("short IS NOT NULL").select("node", "n_shingles", F.col("short").alias("packed"))
        wanted = fresh.select(F.explode(F.array("a", "b")).alias("node"))
        sets = maybe_among(short.unionByName(self.sets), "node", wanted)
        left = sets.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("packed").alias("pa"))
        right = sets.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("packed").alias("pb"))
        joined = fresh.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "pa", "pb")
        checked = joined.mapInArrow(_confirm(self.percent), _PAIRS)
        known = self.scratch.save(checked.unionByName(pairs.where("linked")), name)
        self.proposed = known if self.proposed is None else self.proposed.unionByName(known)
        self.labels = self.scratch.save(connected_components(self.proposed.where("linked"), "a", "b", scratch=self.scratch), "labels")

    def _pivot_pairs(self, rows: DataFrame) -> DataFrame:
        """rows: path, node and the class's columns. Each member of a large node with each of the node's pivots."""
        slot = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(self.pivots)).alias("slot")
        chosen = rows.groupBy("path", slot).agg(F.min(F.struct(F.xxhash64("node", F.lit(11)).alias("h"), "node")).alias("p"))
        chosen = chosen.select("path", F.col("p.node").alias("node")).join(rows, ["path", "node"])
        chosen = chosen.select("path", *(F.col(c).alias(f"p_{c}") for c in ("node", "label", "n_shingles", "sig", "short")))
        pairs = rows.join(chosen, "path").where("label <> p_label")
        pairs = pairs.select("node", "n_shingles", "sig", "short", "p_node", "p_n_shingles", "p_sig", "p_short")
        return pairs.mapInArrow(_to_pivots(self.percent), _PAIRS)

    def _settle(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """rows: path, node of large nodes after their pivots. What to finish as (path, node), and the paths to branch again.

        Where at most a leaf of members lies outside the largest component, these
        join every block of that component; members of one component need no comparison.
        """
        rows = self._open(rows)
        per = rows.groupBy("path", "label").agg(F.count("*").alias("n")).groupBy("path")
        per = per.agg(F.sum("n").alias("all"), F.max(F.struct("n", "label")).alias("top")).select("path", "all", F.col("top.n").alias("n"), F.col("top.label").alias("most"))
        half = self.leaf // 2
        near = rows.join(per.where(F.col("all") - F.col("n") <= self.leaf), "path").withColumn("blocks", F.ceil(F.col("n") / half).cast("int"))
        own = F.array(F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int"))
        spread = F.when(F.col("label") == F.col("most"), own).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
        finish = near.select("path", "node", F.explode(spread).alias("block")).select(F.xxhash64("path", "block").alias("path"), "node")
        return finish, per.where(F.col("all") - F.col("n") > self.leaf).select("path")

    def _grouped(self, groups: DataFrame) -> DataFrame:
        """groups: g, node, label. The rows of each group together, with what a comparison reads."""
        full = groups.join(self.classes, "node").select("g", "node", "label", "n_shingles", "sig", "short")
        return full.repartition("g").sortWithinPartitions("g", "node")

    def _decided(self, members: DataFrame) -> DataFrame:
        """members: g, node of dense groups. Their links, from full sets that are sent to each group once.

        A group whose sets make more than a block of bytes is dealt into several, and each two of these meet.
        """
        label = F.col("node")
        if self.labels is not None:
            members = members.join(self.labels, "node", "left")
            label = F.coalesce("component", "node")
        short = self.classes.where("short IS NOT NULL").select("node", F.col("short").alias("packed"))
        packed = short.unionByName(self.sets.select("node", "packed")).dropDuplicates(["node"])
        rows = members.select("g", "node", label.alias("label")).join(self.classes.drop("doc_id"), "node")
        per = rows.groupBy("g").agg(F.ceil(F.sum(6 * F.col("n_shingles")) / self.block_bytes).cast("int").alias("blocks"))
        rows = rows.join(per, "g").withColumn("own", F.pmod(F.xxhash64("node", F.lit(13)), F.col("blocks")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.withColumn("g", F.xxhash64("g", F.least("own", "other"), F.greatest("own", "other")))
        full = rows.join(packed, "node").select("g", "node", "label", "n_shingles", "sig", "short", "packed")
        return full.repartition("g").sortWithinPartitions("g", "node").mapInArrow(_decide(self.percent), _PAIRS)

    def _distinct_groups(self, rows: DataFrame) -> DataFrame:
        """Small open nodes with their labels, those of equal membership once. rows: path, node."""
        rows = self._open(rows)
        name = rows.groupBy("path").agg(F.count("*").alias("n"), F.sum(F.shiftright(F.xxhash64("node"), 20)).alias("s1"), F.sum(F.shiftright(F.xxhash64("node", F.lit(3)), 20)).alias("s2"))
        keep = name.groupBy("n", "s1", "s2").agg(F.min("path").alias("path"))
        return rows.join(keep.select("path"), "path", "left_semi").select(F.col("path").alias("g"), "node", "label")

    def _block_groups(self, rows: DataFrame) -> DataFrame:
        """What is still large at the last level: each pair of blocks of its members is a group."""
        rows = self._open(rows).withColumn("blocks", F.ceil(2 * F.col("members") / self.leaf).cast("int"))
        own = F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int")
        rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return rows.select(F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other")).alias("g"), "node", "label")

    def run(self) -> DataFrame:
        """(node, component) of classes in a component of more than one class."""
        one = self.rows.where("node IS NOT NULL").dropDuplicates(["node"]).select("node", "sig")
        roots = F.explode(F.array(*(F.xxhash64(F.lit(f"tree {t}")) for t in range(self.trees))))
        rows = self._children(one.select("node", "sig", roots.alias("path"), F.lit(1 << 62).alias("members")))
        rows = self.scratch.save(self._open(rows), "level")
        self._prepare(rows)
        small, dense, level = [], [], 0
        while True:
            small.append(rows.where(F.col("members") <= self.leaf))
            big = rows.where(F.col("members") > self.leaf)
            dense.append(big.where(F.col("members") >= 2 * F.floor(F.col("was") / 3)))
            big = big.where(F.col("members") < 2 * F.floor(F.col("was") / 3))
            if level == self.depth or big.isEmpty():
                dense.append(big)
                break
            full = self.scratch.save(big.select("path", "node", "label", "members").join(self.classes.drop("doc_id"), "node"), "big")
            if level % 3 == 0:
                self._link(self._pivot_pairs(full), f"pivots{level}")
            finish, again = self._settle(full.select("path", "node"))
            small.append(self.scratch.save(finish, "finish"))
            rows = self.scratch.save(self._open(self._children(full.join(again, "path", "left_semi"))), "level")
            level += 1
        nodes, blocks = (functools.reduce(DataFrame.unionByName, (x.select("path", "node") for x in parts)).distinct() for parts in (small, dense))
        any_dense = not blocks.isEmpty()

        def groups() -> DataFrame:
            found = self._distinct_groups(nodes)
            return self._grouped(found.unionByName(self._block_groups(blocks)) if any_dense else found)

        self._link(groups().mapInArrow(_compare(self.percent), _PAIRS), "leaves")
        left = self.scratch.save(groups().mapInArrow(_still_open(self.percent), _OPEN_PAIRS), "open")
        pairs = left.where("b IS NOT NULL").select("a", "b", F.lit(None).cast("boolean").alias("linked"))
        members = left.where("b IS NULL").select("g", F.col("a").alias("node"))
        self._link(pairs if members.isEmpty() else pairs.unionByName(self._decided(members)), "leaves")
        self.scratch.clear(self.rows, self.labels)
        return self.labels


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 75,
    width: int = 5,
    trees: int = 5,
    branches: int = 2,
    leaf: int = 1024,
    depth: int | None = None,
    pivots: int = 4,
    block_bytes: int = _BLOCK_BYTES,
    name_bits: int = 64,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``docs``.

    Links documents whose shingle sets have a Jaccard similarity of at least
    ``percent``/100; ``component_id`` is the smallest id reachable over links,
    ``kept`` marks it.  Null, empty and word-less texts have no shingles and link
    with nothing (a null id stays null and is kept).  Repeated rows are copies of
    each other.  Columns other than the two named are ignored.

    Sets are equal where 128 bits of a digest are; comparisons hold 48 bits of each
    shingle's hash.  ``depth`` bounds the levels of a tree (what is large then is
    compared in blocks), ``block_bytes`` the full sets in a block of a dense node;
    ``name_bits`` below 64 is for tests of names that clash.
    """
    join = ChosenPathJoin(docs, id_col, text_col, percent, width, trees, branches, leaf, depth, pivots, block_bytes, name_bits)
    labels = join.run()
    rows = join.rows.select("doc_id", "n_shingles", "node")
    per_class = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("lowest"))
    per_class = per_class.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = per_class.groupBy("component").agg(F.min("lowest").alias("component_id"))
    named = per_class.join(lowest, "component").select("node", "component_id")
    out = rows.join(named, "node", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
