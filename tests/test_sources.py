import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.plans import staged
from lodestar.provider import RuleProvider
from lodestar.sources import layout, markdown, records, web
from lodestar.streaming import tasks


def test_envelope_shapes(spark, tmp_path):
    shapes = {"a": [{"results": [{"brand": "A"}, {"brand": "B"}]}, {"results": []}], "b": [{"brand": "C"}], "c": {"results": [{"brand": "D"}]}, "d": {"brand": "E"}}
    for name, shape in shapes.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(shape))
    (tmp_path / "e.json").write_text('{"brand": "F"}\n\n{"brand": "G"}\n')
    got = records.read_envelopes(spark, str(tmp_path)).select("brand").collect()
    assert sorted(r.brand for r in got) == list("ABCDEFG")


def test_jsonl_skips_bad_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nbroken\n[1]\n{"a": 2}\n')
    got = records.read_jsonl(spark, str(tmp_path), T.StructType([T.StructField("a", T.IntegerType())])).collect()
    assert sorted(r.a for r in got) == [1, 2]


def test_block_csv_round_trip(spark, tmp_path):
    rows = [("s", "f", "p_page_1", "table", "[0,0,1,1]", 'say "x"', "a | b\nc | d", "")]
    records.write_blocks_csv(spark.createDataFrame(rows, records.BLOCKS), str(tmp_path / "out"))
    got = records.read_blocks_csv(spark, str(tmp_path / "out")).collect()
    assert got[0].content == 'say "x"' and got[0].table_data == "a | b \\n c | d"


def span(text=None, **more):
    return {"spans": [{"type": "text", "content": text, **more}]}


def test_layout(spark, tmp_path):
    page = {"page_idx": 0, "para_blocks": [{"type": "title", "bbox": [0, 0, 5, 5], "index": 1, "lines": [span("T")]}, {"type": "table", "bbox": [0, 9, 5, 5], "index": 2, "blocks": [{"type": "b", "lines": [span(None, html="<table><tr><td>a&amp;b</td><td> c </td></tr><tr><td></td></tr></table>")]}]}, {"type": "text", "bbox": None, "index": 0, "lines": [span("first")]}], "discarded_blocks": [{"type": "footer", "lines": [span("x")]}]}
    (tmp_path / "one.json").write_text(json.dumps({"pdf_info": [page]}))
    (tmp_path / "two.json").write_text(json.dumps({"documents": [{"id": "d", "content": json.dumps({"pdf_info": [page, page]})}, {"id": "e", "content": "broken"}]}))
    pages = layout.read_layout(spark, str(tmp_path))
    assert pages.count() == 3
    rows = layout.blocks(pages)
    assert {r.type for r in rows.collect()} == {"title", "table", "text", "discarded_footer"}
    text = layout.page_texts(rows, ["file", "doc_pos", "page_pos"]).first().text
    assert text == "first\n\n[title] T\n\n[table]\na&b | c"


def test_markdown(spark, tmp_path):
    body = "# Head\ntext " + "word " * 20 + "\n1/2\n- item\n<table><tr><td>x</td></tr></table>\n![](i.png)\n"
    group = tmp_path / "brand"
    group.mkdir()
    (group / "part_1_5_doc_result.md").write_text(body)
    (group / "part_6_9_doc_result.md").write_text(body)
    (group / "abcdefghijklmnopqrstuv.md").write_text(body)
    (group / "short.md").write_text("x")
    files = records.read_markdown(spark, str(tmp_path))
    tasks_found = records.discover_tasks(files).collect()
    assert [(t.doc_key, len(t.md_files)) for t in tasks_found] == [("doc", 2)]
    kinds = markdown.lines(files.where("file = 'part_1_5_doc_result.md'").select("file", "text")).orderBy("line").collect()
    assert [(k.kind, k.segment) for k in kinds] == [("title", 0), ("text", 0), ("list", 1), ("table", 1), ("image", 1)]
    assert kinds[3].table_data == "x"


def test_reshape_and_split():
    seg = pd.DataFrame({"order": [0, 1, 2], "text": ["aaaa", "b", "cc"]})
    assert markdown.reshape(seg, 2)["text"].tolist() == ["aaaa\nb", "cc"]
    assert len(markdown.reshape(pd.DataFrame({"order": [0], "text": ["a\nb\nc\nd"]}), 3)) == 3
    assert markdown.split_text("aa\n\nbb\n\ncccccc", 5) == ["aa", "bb", "ccccc", "c"] or markdown.split_text("aa\n\nbb\n\ncccccc", 6) == ["aa\n\nbb", "cccccc"]
    assert markdown.split_text(None, 5) == [] and "".join(markdown.split_text("x" * 23, 5)) == "x" * 23


def test_web(spark):
    html = '<title>A &amp; B</title><h1>H</h1><a href="/n/news/1">x</a><a href="sub.html">y</a><a href="/n/news/1">x</a><a href="#top">z</a><p>first</p>'
    df = spark.createDataFrame([(1, "https://h.org/dir/page.html?q=1", html), (2, "u", None)], "page_id long, url string, html string")
    got = {r.page_id: r for r in web.page_content(df).collect()}
    assert (got[1].title, got[1].heading, got[1].paragraph, got[1].n_links, got[2].title) == ("A & B", "H", "first", 4, "")
    links = [(r.url, r.is_article) for r in web.page_links(df).orderBy("link_no").collect()]
    assert links == [("https://h.org/n/news/1", True), ("https://h.org/dir/sub.html", False), ("#top", False)]


def test_stream_keeps_first_and_is_repeatable(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    for part in ([("a",), ("b",)], [("b",), ("c",)]):
        spark.createDataFrame(part, "k string").coalesce(1).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema("k string").option("maxFilesPerTrigger", 1).parquet(source)
    tasks.run_available(stream(), tasks.keep_new(sink, "k"), str(tmp_path / "c1"))
    tasks.run_available(stream(), tasks.keep_new(sink, "k"), str(tmp_path / "c1"))
    assert sorted(r.k for r in spark.read.parquet(sink).collect()) == ["a", "b", "c"]


def test_messages_and_states(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.json").write_text('{"task_id": "1", "action": "build"}\nbroken\n{"task_id": "2", "action": "odd"}\n')
    seen = {"build": [], "rest": []}
    handle = tasks.dispatch({"build": lambda d: seen["build"].extend(r.task_id for r in d.collect())}, lambda d: seen["rest"].extend(r.task_id for r in d.collect()))
    tasks.run_available(tasks.messages(spark, str(tmp_path / "in")), handle, str(tmp_path / "c"))
    assert seen == {"build": ["1"], "rest": ["2"]}
    states = spark.createDataFrame([(None, "created"), ("pending", "started"), ("running", "failed"), ("completed", "started")], "c string, e string").select(tasks.next_status("c", "e").alias("s"))
    assert [r.s for r in states.collect()] == ["pending", "running", "failed", "completed"]
    merged = tasks.merge_latest(spark.createDataFrame([("1", 1, "x", "y")], "k string, at int, a string, b string"), spark.createDataFrame([("1", 2, "z", None)], "k string, at int, a string, b string"), "k", "at").first()
    assert (merged.at, merged.a, merged.b) == (2, "z", "y")


def test_staged_extraction(spark, tmp_path):
    text = "Acme makes the Delta Series with DX1000-A.\nPower: 3 kW"
    pages = spark.createDataFrame([("d", 1, 1, text), ("d", 2, 2, "Acme Delta Series again DX1000-A"), ("d", 3, 3, None)], "doc string, page int, seq long, text string").withColumn("text", F.coalesce("text", F.lit("")))
    out = staged.run(spark, pages, str(tmp_path), RuleProvider(["Acme"]))
    assert [(r.brand, r.series, r.model) for r in out["models"].collect()] == [("Acme", "Delta", "DX1000-A")]
    product = out["products"].first()
    assert ("Power", "3", "kw") in [tuple(x) for x in product.specs]
