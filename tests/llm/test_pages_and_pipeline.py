import itertools
import random
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestar.llm import compression_quality, html_extract
from lodestar.llm.dom import Page, parse

DATA = "/root/testdata/sf0.001"


def text_of(source):
    return html_extract.main_text([source], html_extract.trained())[0]


def test_held_out_pages():
    exact, total = 0, 150
    model = html_extract.trained()
    for k in range(total):
        page, main = html_extract.labelled_page(900_000_000 + k)
        kept = html_extract.decode(page, model.log_odds(html_extract.node_features(page)))
        exact += page.text(kept) == page.text(main)
        assert all(not kept[i] or i == 0 or kept[page.parent[i]] for i in range(len(page.tag)))
    assert exact / total > 0.97


def test_a_page():
    source = (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- ad -->'
        '<div class="ad">Buy this.</div><article><h1>Head &amp; line</h1><p><b>Bold\n text<br><p>Second <i>one</i>.</p><div class="ad">More ads</div><p>Of.</p></article>'
        '<section class="comments"><p>I think that this is a rather long comment of a reader, with words.</p></section><footer>&copy; site</footer></body></html>'
    )
    assert text_of(source) == "Head & line Bold text Second one. Of."


@pytest.mark.parametrize("source", [None, "", "<", "<p", "</", "<!--", "<script>x", "plain < text", "<a href='x", "<div><div><p>", "&#x110000;", "<p>" * 2000])
def test_odd_sources(source):
    assert isinstance(text_of(source), str)


@pytest.mark.parametrize("source", ["</i>" * 200_000, "<b>" * 60_000 + "</i>" * 60_000, "<b>" * 40_000 + "<p></p>" * 40_000, "<p><div>" + "<b>" * 40_000 + "<hr>" * 40_000, "<div>" + "<b><li>" * 40_000, "<a " + '"' * 200_000 + ">", "<a b='>" * 60_000, "<table>" + "<b><tr>" * 40_000])
def test_reading_takes_time_in_proportion(source):
    began = time.time()
    parse(source)
    assert time.time() - began < 5


def brute_decoding(parents, odds):
    """The best total of every set of elements that holds the parent of each of its own."""
    best = 0.0
    for bits in itertools.product([False, True], repeat=len(parents)):
        if all(not bits[k] or k == 0 or bits[parents[k]] for k in range(len(parents))):
            best = max(best, sum(o for o, b in zip(odds, bits, strict=True) if b))
    return best


def test_decoding_against_brute_force():
    r = random.Random(3)
    for _ in range(150):
        n = r.randint(1, 11)
        parents = [-1, *(r.randrange(k) for k in range(1, n))]
        page = Page(tag=["#page", *("div" for _ in range(n - 1))], parent=parents, marks=[""] * n)
        odds = np.array([r.gauss(0, 2) for _ in range(n)])
        kept = html_extract.decode(page, odds)
        assert all(not kept[k] or k == 0 or kept[parents[k]] for k in range(n))
        assert abs(odds[kept].sum() - brute_decoding(parents, odds)) < 1e-9


ONE = "The ferry left the harbour at dawn, with forty passengers and a cargo of letters, and nobody on the pier looked up."
TWO = "By noon the wind had turned, so the captain put in at the next island, where the post office had been closed for years."
#: Layouts that the page maker does not write: name, source, text.
LAYOUTS = [
    ("tables for layout", f'<table><tr><td class="nav"><a href=a>Home</a> <a href=b>News</a></td><td class="content"><h1>A crossing</h1><p>{ONE}</p><p>{TWO}</p></td></tr></table>', f"A crossing {ONE} {TWO}"),
    ("nested wrappers", f'<div><div><div class="header"><a href="/">Site</a></div><div><div class="post"><h2>A crossing</h2><p>{ONE}</p><div><p>{TWO}</p></div></div></div></div><div class="footer">Imprint</div></div>', f"A crossing {ONE} {TWO}"),
    ("upper-case tags", f'<HTML><BODY><NAV><A HREF=x>Start</A></NAV><ARTICLE><H1>A crossing</H1><P>{ONE}<P>{TWO}</ARTICLE><FOOTER>(c)</FOOTER></BODY></HTML>', f"A crossing {ONE} {TWO}"),
    ("section in main", f'<main><section><h1>A crossing</h1><p>{ONE}</p></section><section><p>{TWO}</p></section></main><aside><ul><li><a href=x>More</a></li></ul></aside>', f"A crossing {ONE} {TWO}"),
    ("comments in lists", f'<article><h1>A crossing</h1><p>{ONE}</p><p>{TWO}</p></article><div id="comments"><ol><li><p>I was on that ferry as well, and I remember the letters.</p></li></ol></div>', f"A crossing {ONE} {TWO}"),
]


@pytest.mark.parametrize("name, source, text", LAYOUTS, ids=[x[0] for x in LAYOUTS])
def test_layouts_of_another_hand(name, source, text):
    assert text_of(f"<!DOCTYPE html><html><body>{source}</body></html>") == text


def test_blocks_and_references():
    page = parse("<div>a<b>b</b>c<p>d\n  e&nbsp;f<li>g</div>tail")
    assert page.text([True] * len(page.tag)) == "abc d e f g tail"


def test_extract_columns(spark):
    df = spark.createDataFrame([(1, "u", "<article><p>x y</p></article>"), (2, None, None)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    rows = {r.page_id: r for r in html_extract.extract(df).collect()}
    assert rows[1].n_chars == len(rows[1].text) and (rows[2].text, rows[2].n_chars) == ("", 0)
    assert html_extract.extract(df.limit(0)).collect() == []


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "pii", "packing"]
    seen = docs
    for name in list(stages)[:3]:
        out = stages[name](spark, seen, DATA)
        assert out.schema.simpleString() == docs.schema.simpleString()
        seen = out
    masked = seen.cache()
    assert 0.5 * docs.count() < masked.count() <= docs.count()
    assert masked.where(F.col("n_chars") != F.length("text")).count() == 0
    assert masked.where(F.col("text").rlike("@mail[0-9]+.example.com")).count() == 0
    pieces = corpus_pipeline.run(spark, DATA)
    per_doc = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t"))
    assert per_doc.where("n <> t").count() == 0 and per_doc.count() == masked.count()
    assert public_tokenizers.path("byte_bpe_50k.json")


ODD = "doc_id long, text string, lang string, source string, n_chars long, row string, node string, component_id string"


def odd_documents(spark, seed):
    """Repeated and null ids, null and empty texts, near copies in any place, and columns of clashing names."""
    r = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows = [(1, None), (1, None), (None, ""), (2, " "), (None, None)]
    for _ in range(25):
        base = r.choices(words, k=r.choice([3, 30, 260]))
        for _ in range(r.randint(1, 5)):
            copy = base[:]
            for _ in range(r.choice([0, 0, 1, 2])):
                copy[r.randrange(len(copy))] = r.choice(words)
            rows.append((r.choice([None, r.randrange(3, 40)]), " ".join(copy) + r.choice(["", " ", " mail me: a@b.cd"])))
    rows += [rows[8]] * 3
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "row", "x", f"c{k}") for k, (i, t) in enumerate(rows)], ODD)


def shingles(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("seed", [1, 2])
def test_near_dedup_stage_against_brute_force(spark, seed):
    docs = odd_documents(spark, seed)
    out = corpus_pipeline.near_dedup(spark, docs, DATA)
    assert out.schema == docs.schema
    rows, sets = docs.collect(), []
    part = list(range(len(rows)))
    for r in rows:
        sets.append(shingles(r.text))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            a, b = part[i], part[j]
            part = [a if x == b else x for x in part]
    left = out.collect()
    assert {r.component_id for r in rows if not shingles(r.text)} <= {r.component_id for r in left}  # wordless rows all stay
    assert len(left) == len({p for p, s in zip(part, sets) if s}) + sum(not s for s in sets)
    group = {r.component_id: p for r, p in zip(rows, part)}
    for r in left:
        if shingles(r.text):
            ids = [x.doc_id for x in rows if group[x.component_id] == group[r.component_id] and x.doc_id is not None]
            assert r.doc_id == min(ids, default=None)


def test_quality_and_pii_stages_on_odd_rows(spark):
    docs = odd_documents(spark, 3)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    out = corpus_pipeline.quality(spark, docs, DATA)
    model = compression_quality.fit(docs, labels)
    want = [r for r in docs.collect() if model.score(r.text) >= 0.7]
    assert out.schema == docs.schema and sorted(map(str, out.collect())) == sorted(map(str, want))
    masked = corpus_pipeline.mask_pii(spark, docs, DATA)
    assert masked.schema == docs.schema
    got, plain = ({r.component_id: r for r in x.collect()} for x in (masked, docs))
    for key, r in got.items():
        old = plain[key].text
        assert r.text == (None if old is None else old.replace("a@b.cd", "[EMAIL]")) and r.n_chars == (None if old is None else len(r.text))
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, DATA).count() == 0
