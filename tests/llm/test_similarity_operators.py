import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import chosen_path, sorted_projection, threshold_topk


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


# ---- documents ----


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def family_texts(seed, families=12):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    common = r.choices(words, k=60)
    texts = [None, "", " \t\n", "one", "one", "ONE", "É two", "é two", "a b c d", "a  b\tc d"]
    for _ in range(families):
        base = r.choices(words, k=r.choice([6, 40, 90, 260, 400]))
        for _ in range(r.randint(1, 9)):
            copy = base[:]
            for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
                copy[r.randrange(len(copy))] = r.choice(words)
            texts.append(" ".join(copy + (common if r.random() < 0.3 else [])))
    texts += [" ".join(common + r.choices(words, k=r.choice([3, 10, 30]))) for _ in range(40)]
    return texts


@pytest.mark.parametrize("seed, leaf, depth", [(1, 1024, 6), (2, 4, 2), (3, 8, 4)])
def test_near_duplicates_against_brute_force(spark, seed, leaf, depth):
    texts = family_texts(seed)
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = {r.doc_id: r for r in chosen_path.near_duplicates(df, leaf=leaf, depth=depth, trees=8).collect()}
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = components(sets, links)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.n_shingles == len(sets[i]) and r.kept == (i == want[i]) for i, r in got.items())
    assert len(links) > 20


def family_of_long_texts(seed, n, length, change, extra=0):
    """Texts of one family in which each two share about the same part."""
    r = random.Random(seed)
    words = [f"w{k}" for k in range(5000)]
    base = r.choices(words, k=length)
    out = []
    for _ in range(n):
        copy = base[:]
        for _ in range(change):
            copy[r.randrange(length)] = r.choice(words)
        out.append(" ".join(copy))
        if extra and r.random() < extra:
            near = copy[:]
            near[r.randrange(length)] = "edit"
            out.append(" ".join(near))
    return out


def check_near_duplicates(spark, texts, **settings):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in chosen_path.near_duplicates(df, **settings).collect()}
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = components(range(len(texts)), links)
    assert {i: r.component_id for i, r in got.items()} == want
    return links


@pytest.mark.parametrize("settings", [{}, {"leaf": 32}, {"leaf": 32, "block_bytes": 20_000}])
def test_near_duplicates_in_a_family_just_below_the_threshold(spark, settings):
    texts = family_of_long_texts(4, 150, 400, 14, 0.3)  # most pairs are near 0.7, those with an edit more are linked
    links = check_near_duplicates(spark, texts, **settings)
    assert 30 < len(links) < len(texts) * len(texts) / 8


def test_near_duplicates_with_clashing_names(spark):
    check_near_duplicates(spark, [t for t in family_texts(5) if t], name_bits=5)
    check_near_duplicates(spark, family_of_long_texts(6, 40, 300, 6), name_bits=3)


def test_common_counts_against_brute_force():
    r = random.Random(2)
    for size in (3, 40, 90):
        sets = [sorted({r.randrange(200 if r.random() < 0.5 else 1 << 40) for _ in range(r.randrange(300))}) for _ in range(size)]
        packed = [chosen_path.pack(np.array(x, np.uint64) << np.uint64(16)) for x in sets]
        i, j = (x.ravel() for x in np.meshgrid(np.arange(size), np.arange(size)))
        apart = i != j
        got = chosen_path._common(packed, i[apart], j[apart])
        assert got.tolist() == [len(set(sets[a]) & set(sets[b])) for a, b in zip(i[apart].tolist(), j[apart].tolist())]


def test_near_duplicates_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (7, None), (8, "long " * 30000)], "doc_id long, text string")
    got = chosen_path.near_duplicates(df).collect()
    assert sorted((r.component_id, r.kept) for r in got if r.doc_id in (None, 5)) == [(5, True), (5, True), (5, True)]
    assert {r.n_shingles for r in got if r.doc_id in (7, 8)} == {0, 1}
    assert chosen_path.near_duplicates(df.limit(0)).collect() == []


# ---- vectors ----


def vector_rows(seed, n=160, dim=16):
    r = np.random.default_rng(seed)
    base = r.standard_normal((n // 8, dim))
    rows = [base[k % len(base)] + r.standard_normal(dim) * r.choice([0.0, 0.05, 0.2, 0.3]) for k in range(n)]
    rows += [rows[0].copy(), rows[0] * 2, np.zeros(dim), rows[3][:5], np.full(dim, 1e200), np.full(dim, 1e-200)]
    out = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    bad = [None, [], [math.nan] * dim, [math.inf] + [0.0] * (dim - 1), [None] + [1.0] * (dim - 1)]
    return out + [(1000 + i, v) for i, v in enumerate(bad)]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_vectors_against_brute_force(spark, seed):
    rows = vector_rows(seed)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("unit", F.lit(1))
    got = {r.vec_id: r for r in sorted_projection.near_vectors(df, block=8).collect()}

    def cosine(a, b):
        if not usable(a) or not usable(b) or len(a) != len(b) or not any(a) or not any(b):
            return -1
        a, b = np.array(a) / max(map(abs, a)), np.array(b) / max(map(abs, b))
        return a @ b / math.sqrt((a @ a) * (b @ b))

    links = [(i, j) for i, a in rows for j, b in rows if i < j and cosine(a, b) >= 0.9]
    want = components([i for i, _ in rows], links)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_links for i, r in got.items()} == {i: sum(i in pair for pair in links) for i, _ in rows}
    assert sorted_projection.near_vectors(df.limit(0)).collect() == []


def test_near_vectors_with_clashing_names_and_boundary_pairs(spark):
    rows = vector_rows(3)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = sorted(map(tuple, sorted_projection.near_vectors(df).collect()))
    assert sorted(map(tuple, sorted_projection.near_vectors(df, name_bits=4, block=8).collect())) == want
    r = np.random.default_rng(1)
    m = sorted_projection._units([x.astype(np.float32).tobytes() for x in r.standard_normal((300, 64))], 64)
    least = float(m[3] @ m[7])  # a pair that rounding decides
    whole = sorted_projection._near(m, m, least)
    assert (whole == whole.T).all()
    for k in range(0, 300, 7):
        assert (sorted_projection._near(m[k : k + 7], m, least) == whole[k : k + 7]).all()


def planted_vectors(seed, n, dense):
    """Unit vectors in 64 dimensions, a share of them around one direction, and for a third of all a partner at cosine 0.901."""
    r = np.random.default_rng(seed)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    m = unit(r.standard_normal((n, 64)))
    hot = int(n * dense)
    m[:hot] = unit(math.sqrt(0.8) * unit(r.standard_normal((1, 64))) + math.sqrt(0.2) * m[:hot])
    base = m[::3]
    side = r.standard_normal(base.shape)
    side = unit(side - (side * base).sum(axis=1, keepdims=True) * base)
    return np.concatenate([m, 0.901 * base + math.sqrt(1 - 0.901**2) * side])


@pytest.mark.parametrize("dense, settings", [(0, {"leaf": 64, "exhaustive": 256}), (0.33, {}), (0.33, {"leaf": 64, "exhaustive": 256})])
def test_near_vectors_finds_isolated_pairs_and_dense_groups(spark, dense, settings):
    m = planted_vectors(3, 6000, dense)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in sorted_projection.near_vectors(df, **settings).collect()}
    near = np.triu(m @ m.T >= 0.9, 1)
    links = list(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))
    assert {i: r.component_id for i, r in got.items()} == components(range(len(m)), links)
    assert [got[i].n_links for i in range(len(m))] == (near.sum(0) + near.sum(1)).tolist()


@pytest.mark.parametrize("seed", [1, 2])
def test_top_k_against_brute_force(spark, seed):
    r = random.Random(seed)
    rows = [(i, [r.choice([-1.0, 0.0, 0.5, r.random()]) for _ in range(6)]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 340)] + [(400, None), (401, [math.nan] * 6), (402, [0.25]), (500, [0.0] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in threshold_topk.top_k(df, block=50, query_block=2).collect())
    ints = {i: [math.floor(1024 * x) for x in v] for i, v in rows if i is not None and usable(v)}
    want = []
    for q in sorted(i for i in ints if i % 100 == 0):
        scored = sorted((-sum(a * b for a, b in zip(ints[q], ints[c])), c) for c in ints if c != q)
        want += [(q, k, c, -s) for k, (s, c) in enumerate(scored[:10], 1)]
    assert got == want


def test_top_k_keeps_rows_that_share_an_id(spark):
    rows = [(0, [1.0, 0.0]), (7, [0.5, 0.0]), (7, [0.9, 0.0]), (8, [0.6, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["rank"], r.vec_id, r.score) for r in threshold_topk.top_k(df).orderBy("rank").collect()]
    assert got == [(1, 7, 1024 * 921), (2, 8, 1024 * 614), (3, 7, 1024 * 512)]


@pytest.mark.parametrize("seed", [1, 2])
def test_top_k_of_hot_and_repeated_ids_against_brute_force(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice([5, 5, 100, r.randrange(400)]), [r.choice([-1.0, 0.0, 0.5, r.random()]) for _ in range(5)]) for _ in range(900)]
    rows += [rows[3]] * 300
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(x) for x in threshold_topk.top_k(df, block=30, query_block=3).collect())
    ints = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    want = []
    for q in sorted({i for i, _ in rows if i % 100 == 0}):
        scored = sorted((-sum(a * b for a, b in zip(x, v)), c) for i, x in ints if i == q for c, v in ints if c != q)
        want += [(q, k, c, -s) for k, (s, c) in enumerate(scored[:10], 1)]
    assert got == want


def test_top_k_small_and_large_values(spark):
    df = spark.createDataFrame([(0, [1e30, -1.0]), (1, [1.0, 2.0]), (2, [-3.0, 1.0])], "vec_id long, embedding array<double>")
    got = threshold_topk.top_k(df).orderBy("rank").collect()
    assert [(r.vec_id, r.score > 0) for r in got] == [(1, True), (2, False)]
    assert threshold_topk.top_k(df.limit(0)).collect() == []


def test_threshold_walk_stops_early():
    r = np.random.default_rng(0)
    values = r.integers(-5, 5, (5000, 4))
    values[:20] = 1000
    lists = threshold_topk.SortedLists(np.arange(5000), values)
    ids, scores = lists.top(np.array([1, 1, 1, 1]), 0, 10)
    assert ids == list(range(1, 11)) and set(scores) == {4000}
