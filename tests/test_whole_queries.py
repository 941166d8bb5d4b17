"""Registered queries over small tables of their own, against brute force."""

import random

from lodestar.plans.queries import QUERIES
from lodestar.plans.views import entities


def written(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_batch_envelope_regroups_every_order_and_line(spark, tmp_path):
    orders = [(k,) for k in (1, 7, 10, 20, 33)]
    items = [(k, n, 100 * k + n, float(n)) for k in (1, 10, 33) for n in range(1, 8)]
    sf = written(spark, tmp_path, orders=(orders, "o_orderkey long"), lineitem=(items[::-1], "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double"))
    got = {r.batch: (r.n, r.results) for r in QUERIES["batch_envelope"](spark, sf).collect()}
    lines = {k: [f"{p}:{int(q)}" for o, _, p, q in items if o == k] for (k,) in orders}
    assert got == {k: (len(x), ";".join(x)) for k, x in lines.items()}


def test_vector_search_asks_with_every_hundredth_id(spark, tmp_path):
    r = random.Random(4)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)], 0) for i in range(1, 1301) if i not in (3, 77, 141)]
    sf = written(spark, tmp_path, embeddings=(rows, "vec_id long, embedding array<double>, label int"), documents=([(i, f"text {i}") for i, _, _ in rows], "doc_id long, text string"))
    got = {(x.query_id, x["rank"]): (x.doc_id, x.text) for x in QUERIES["vector_search"](spark, sf).collect()}
    unit = {i: [x / sum(y * y for y in v) ** 0.5 for x in v] for i, v, _ in rows}
    want = {}
    for q in range(100, 1301, 100):
        scored = sorted((-sum(a * b for a, b in zip(unit[q], unit[i], strict=True)), i) for i in unit)
        want |= {(q, k): (i, f"text {i}") for k, (s, i) in enumerate(scored[:10], 1) if -s >= 0.25}
    assert got == want and len(want) == 130


def test_bind_known_models_binds_even_rows_too(spark, tmp_path):
    r = random.Random(6)
    words = ["red", "blue", "green", "steel", "brass", "bolt", "ring"]
    rows = [(i, " ".join(r.choices(words, k=3)), f"Brand#{r.randint(1, 9)}", r.choice(["SMALL", "LARGE"]), r.randint(1, 9), 1.0) for i in range(1, 241)]
    sf = written(spark, tmp_path, part=(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"))
    e = [(x.seq, x.category, x.product_model) for x in entities(spark, sf).collect()]
    known = {(c, "-".join(m.split("-")[:2])) for s, c, m in e if s % 3 == 0} | {(c, m) for s, c, m in e if s % 5 == 0}
    want = []
    for seq, category, model in e:
        inside = sorted((-len(m), m) for c, m in known if c == category and m in model)
        want += [(seq, model)] if (category, model) in known else [(seq, m) for _, m in inside[:12]]
    got = sorted((x.seq, x.known_model) for x in QUERIES["bind_known_models"](spark, sf).collect())
    assert got == sorted(want) and any(seq % 2 == 0 for seq, _ in got)


def test_name_occurrences_finds_items_of_any_length(spark, tmp_path):
    items = [(1, "Fan"), (2, "red fan"), (3, "a b c d e"), (4, "a b c d e f"), (5, "a b c d e f g h"), (6, "..."), (7, None)]
    docs = [(1, "The red-fan."), (2, "fan"), (3, "x a b c d e f g h y"), (4, "fans of a b c d e"), (5, ""), (6, None)]
    sf = written(spark, tmp_path, benchmark=(items, "item_id long, text string"), documents=(docs, "doc_id long, text string"))
    got = sorted((x.item_id, x.doc_id) for x in QUERIES["name_occurrences"](spark, sf).collect())
    assert got == [(1, 1), (1, 2), (2, 1), (3, 3), (3, 4), (4, 3), (5, 3)]
