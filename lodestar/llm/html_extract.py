"""The main text of web pages: boosted trees over DOM nodes, decoded so that the tree agrees with itself.

Each element gets features of itself, its subtree, its attribute words, its siblings
and its ancestors; boosted trees, trained on generated pages, give the log-odds that
it belongs to the article (or holds it).  The decoder takes the set of elements of
the highest total log-odds in which every kept element has a kept parent, found by
one pass up and one pass down the tree, so no descendant of a dropped element stays.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm import synthetic_pages
from lodestar.llm.boosted import BoostedTrees, fit_trees
from lodestar.llm.dom import SILENT, Page, mark_words, parse

_TAG_GROUPS = ["article", "main", "nav", "header", "footer", "aside", "form button input select label fieldset", "p", "h1 h2 h3 h4 h5 h6", "li ul ol dl dt dd", "a", "b i em strong span code u small sup sub mark", "div section", "body html #page", "table tr td th tbody thead", "blockquote pre figure figcaption q cite"]
_TAG_CODE = {tag: k for k, tags in enumerate(_TAG_GROUPS, 1) for tag in tags.split()}
_WORD_GROUPS = [
    "ad ads advert advertisement advertising adslot sponsor sponsored promo promotion ins",
    "banner cookie cookies consent gdpr notice alert popup modal overlay",
    "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager",
    "sidebar side rail widget widgets related recommended complementary aside",
    "comment comments reply replies respond response responses disqus",
    "share social follow newsletter subscribe signup login search form",
    "footer copyright legal contentinfo colophon",
    "header masthead topbar logo tagline",
    "article content main post entry story body text page",
    "hidden none",
]
_WORD_CODE = {word: k for k, words in enumerate(_WORD_GROUPS) for word in words.split()}
_LANDMARKS = {"article": 1, "main": 2, "nav": 3, "header": 4, "footer": 5, "aside": 6, "form": 7}
_N_WORDS = len(_WORD_GROUPS)


def node_features(page: Page) -> np.ndarray:
    """One row for each element."""
    n = len(page.tag)
    parent = page.parent
    own_chars, own_words, own_marks = [0] * n, [0] * n, [0] * n
    for node, text in zip(page.chunk_node, page.chunk_text, strict=True):
        words = text.count(" ") + 1 if text.strip() else 0
        own_chars[node] += len(text) if words else 0
        own_words[node] += words
        own_marks[node] += text.count(",") + text.count(".")
    chars, words, points = own_chars[:], own_words[:], own_marks[:]
    linked, paragraphs, items, nodes = [0] * n, [0] * n, [0] * n, [1] * n
    for k in range(n - 1, -1, -1):
        tag = page.tag[k]
        if tag in SILENT:
            chars[k] = words[k] = points[k] = 0
        if tag == "a":
            linked[k] = chars[k]
        p = parent[k]
        if p >= 0:
            chars[p] += chars[k]
            words[p] += words[k]
            points[p] += points[k]
            linked[p] += linked[k]
            nodes[p] += nodes[k]
            paragraphs[p] += paragraphs[k] + (tag == "p")
            items[p] += items[k] + (tag == "li")
    depth, before, order, alike, siblings = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    landmark, above = [0] * n, [0] * n  # nearest landmark at or above; bit set of word groups at or above
    mark_bits = [0] * n
    above_body = 0
    seen: dict[tuple[int, str], int] = {}
    count: dict[int, int] = {}
    for k in range(n):
        p, tag = parent[k], page.tag[k]
        bits = 0
        if page.marks[k]:
            for word in mark_words(page.marks[k]):
                code = _WORD_CODE.get(word)
                if code is not None:
                    bits |= 1 << code
        if tag in ("body", "html"):
            bits = 0
        mark_bits[k] = bits
        before[k] = above_body
        above_body += own_chars[k] if tag not in SILENT else 0
        if p >= 0:
            depth[k] = depth[p] + 1
            order[k] = count[p] = count.get(p, -1) + 1
            seen[p, tag] = alike[k] = seen.get((p, tag), 0) + 1
            landmark[k] = _LANDMARKS.get(tag, landmark[p])
            above[k] = above[p] | bits
        siblings[k] = 0
    for k in range(n):
        siblings[k] = count.get(parent[k], 0)
    total = max(1, chars[0])
    a = np.array([own_chars, chars, words, points, linked, paragraphs, items, nodes, depth, before, order, alike, siblings, landmark], float)
    own_chars, chars, words, points, linked, paragraphs, items, nodes, depth, before, order, alike, siblings, landmark = a
    up = np.array([max(p, 0) for p in parent])
    code = np.array([_TAG_CODE.get(t, 0) for t in page.tag], float)
    bits = np.array(mark_bits)
    high = np.array(above)
    safe = np.maximum(chars, 1)
    columns = [
        code, code[up], landmark, depth, np.log1p(own_chars), np.log1p(chars), np.log1p(words), linked / safe, points / safe, chars / (nodes * 10 + chars), np.log1p(nodes),
        paragraphs, items, chars / total, before / total, order, alike, siblings, linked[up] / safe[up], np.log1p(chars[up]), chars / np.maximum(chars[up], 1), paragraphs[up], code[up[up]],
        np.array([t in SILENT for t in page.tag], float),
    ]
    columns += [(bits >> g & 1).astype(float) for g in range(_N_WORDS)]
    columns += [(high >> g & 1).astype(float) for g in range(_N_WORDS)]
    return np.stack(columns, axis=1)


def decode(page: Page, log_odds: np.ndarray) -> np.ndarray:
    """The kept elements: of the largest total log-odds such that the parent of a kept one is kept."""
    n = len(page.tag)
    gain = log_odds.tolist()
    for k in range(n):
        if page.tag[k] in SILENT:
            gain[k] = -1e9
    best = gain[:]
    for k in range(n - 1, 0, -1):
        if best[k] > 0:
            best[page.parent[k]] += best[k]
    keep = np.zeros(n, bool)
    for k in range(n):
        keep[k] = best[k] > 0 and (k == 0 or keep[page.parent[k]])
    return keep


def training_set(pages: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and weights of the elements of generated pages."""
    xs, ys, ws = [], [], []
    for k in range(pages):
        page, main = labelled_page(seed * 1_000_003 + k)
        x = node_features(page)
        xs.append(x)
        ys.append(main)
        ws.append(1 + np.log1p(np.expm1(x[:, 4])) / 3)
    return np.concatenate(xs), np.concatenate(ys).astype(float), np.concatenate(ws)


def labelled_page(seed: int) -> tuple[Page, np.ndarray]:
    """A generated page and which of its elements are the article, part of it, or around it."""
    source = synthetic_pages.PageMaker(seed).page()
    page = parse(source.replace(f" {synthetic_pages.MAIN}", ' role="x-main"').replace(f" {synthetic_pages.OTHER}", ' role="x-other"'))
    n = len(page.tag)
    state = [0] * n
    for k in range(n):
        own = page.marks[k]
        inherited = state[page.parent[k]] if k else 0
        state[k] = 2 if "role=x-other" in own else 1 if "role=x-main" in own else inherited
        page.marks[k] = own.replace("role=x-other", "").replace("role=x-main", "").strip()
    main = np.array(state) == 1
    for k in range(n - 1, 0, -1):
        if main[k] and state[page.parent[k]] == 0:
            main[page.parent[k]] = True
    return page, main


@lru_cache(maxsize=2)
def trained(pages: int = 800, seed: int = 3) -> BoostedTrees:
    """The model, fitted on ``pages`` generated pages; the same for the same parameters."""
    return fit_trees(*training_set(pages, seed))


def main_text(sources: list[str | None], model: BoostedTrees) -> list[str]:
    """The main text of each page; empty for null or empty ones and where nothing belongs to an article."""
    parsed = [parse(source or "") for source in sources]
    if not parsed:
        return []
    log_odds = model.log_odds(np.concatenate([node_features(page) for page in parsed]))
    cuts = np.cumsum([0] + [len(page.tag) for page in parsed])
    return [page.text(decode(page, log_odds[lo:hi])) for page, lo, hi in zip(parsed, cuts, cuts[1:], strict=False)]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: BoostedTrees | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for each row: the main text of the whole page and its number of code points.

    White space inside a block becomes one space, blocks follow each other after one
    space.  A null or empty page gives an empty text; columns other than the three
    named are ignored.
    """
    model = model or trained()

    def run(batches):
        for batch in batches:
            sources = batch.column(2).to_pylist()
            texts = [t for at in range(0, len(sources), 256) for t in main_text(sources[at : at + 256], model)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return source.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
