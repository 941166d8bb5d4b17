"""Labelled web pages made from a seed, to train the extractor on: many layouts, invented words."""

from __future__ import annotations

import random

MAIN, OTHER = "data-main", "data-other"


class PageMaker:
    """Writes one page; attributes ``data-main`` and ``data-other`` mark what is article and what is not."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        letters = [self.r.choice("bcdfglmnprst") + self.r.choice("aeiou") for _ in range(24)] + ["ing", "tion", "ée", "ß", "ñ"]
        self.vocabulary = ["".join(self.r.choices(letters, k=self.r.randint(1, 4))) for _ in range(120)]

    def words(self, n: int) -> str:
        out = []
        for w in self.r.choices(self.vocabulary, k=n):
            out.append(w + self.r.choice(["", "", "", "", ",", ".", " |", "$$$", "&amp;", "&nbsp;"]))
        return " ".join(out).capitalize()

    def pick(self, *choices: str) -> str:
        return self.r.choice(choices)

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{self.r.choice(self.vocabulary)}">{self.words(self.r.randint(1, 3))}</a></li>' for _ in range(n))

    def inline(self, n: int) -> str:
        text = self.words(n)
        kind = self.r.random()
        if kind < 0.15:
            return f"<b>{text}"  # never closed
        if kind < 0.3:
            return f"{text} <{(t := self.pick('b', 'em', 'i', 'strong', 'span', 'code'))}>{self.words(2)}</{t}> {self.words(3)}"
        if kind < 0.4:
            return f'{text} <a href="/x">{self.words(2)}</a> {self.words(4)}'
        return text

    def length(self) -> int:
        return self.pick_int((1, 6), (5, 30), (30, 120), (100, 300))

    def pick_int(self, *ranges: tuple[int, int]) -> int:
        return self.r.randint(*self.r.choice(ranges))

    def body_blocks(self) -> str:
        out = [f"<{(h := self.pick('h1', 'h1', 'h2'))}>{self.words(self.r.randint(2, 10))}</{h}>"] if self.r.random() < 0.9 else []
        for _ in range(self.pick_int((1, 3), (2, 9), (6, 14))):
            kind = self.r.random()
            if kind < 0.72:
                out.append(f"<p>{self.inline(self.length())}" + self.pick("</p>", "</p>", "</p>", "<br>", ""))
            elif kind < 0.78:
                out.append(f"<h2>{self.words(4)}</h2>")
            elif kind < 0.84:
                out.append("<ul>" + "".join(f"<li>{self.inline(self.r.randint(2, 20))}</li>" for _ in range(self.r.randint(2, 6))) + "</ul>")
            elif kind < 0.88:
                out.append(f"<blockquote><p>{self.words(20)}</p></blockquote>")
            elif kind < 0.91:
                out.append("<table>" + "".join(f"<tr><td>{self.words(1)}</td><td>{self.words(2)}</td></tr>" for _ in range(3)) + "</table>")
            elif kind < 0.94:
                out.append(f"<figure><img src=x><figcaption>{self.words(6)}</figcaption></figure>")
            elif kind < 0.96:
                out.append(f"<pre>{self.words(12)}</pre>")
            else:
                out.append(self.aside())
        return "".join(out)

    def aside(self) -> str:
        """Something foreign that may stand within the article as well."""
        name = self.pick("ad", "ads", "advert", "ad-slot", "sponsored", "promo", "share-buttons", "social-share", "related-posts", "newsletter", "notice", "cookie-notice", "banner", "popup", "toc-menu")
        text = self.pick(self.words(self.r.randint(2, 12)), f"<p>{self.words(self.r.randint(3, 25))}</p>", f"<ul>{self.links(3)}</ul>")
        tag = self.pick("div", "div", "aside", "section", "ins")
        return f'<{tag} {self.pick("class", "class", "id")}="{name}" {OTHER}>{text}</{tag}>'

    def navigation(self) -> str:
        inner = f"<ul>{self.links(self.r.randint(2, 9))}</ul>"
        return self.pick(f"<nav {OTHER}>{inner}</nav>", f"<nav {OTHER}>{inner}</nav>", f'<div class="{self.pick("menu", "nav", "navbar", "main-menu", "breadcrumbs", "breadcrumb")}" {OTHER}>{inner}</div>', f'<ul class="menu" {OTHER}>{self.links(5)}</ul>', f'<div role="navigation" {OTHER}>{inner}</div>')

    def header(self) -> str:
        inner = f'<{(t := self.pick("h1", "h2", "div", "p"))}><a href="/">{self.words(2)}</a></{t}><p>{self.words(5)}</p>'
        return self.pick(f"<header {OTHER}>{inner}{self.navigation()}</header>", f'<div id="{self.pick("header", "masthead", "site-header", "topbar")}" {OTHER}>{inner}</div>')

    def form(self) -> str:
        inner = f"<label>{self.words(2)}</label><input type=text><button>{self.words(1)}</button>"
        return self.pick(f"<form {OTHER}>{inner}</form>", f'<div class="{self.pick("search", "subscribe", "newsletter-signup", "login")}" {OTHER}><form>{inner}</form></div>')

    def sidebar(self) -> str:
        inner = "".join(f'<div class="widget"><h3>{self.words(2)}</h3><ul>{self.links(4)}</ul><p>{self.words(self.r.randint(3, 30))}</p></div>' for _ in range(self.r.randint(1, 3)))
        return self.pick(f"<aside {OTHER}>{inner}</aside>", f'<div class="{self.pick("sidebar", "side-bar", "right-rail", "related", "widgets")}" {OTHER}>{inner}</div>', f'<div role="complementary" {OTHER}>{inner}</div>')

    def comments(self) -> str:
        inner = "".join(f'<{(t := self.pick("div", "li", "article"))} class="comment"><b>{self.words(1)}</b><p>{self.words(self.pick_int((3, 20), (20, 90)))}</p></{t}>' for _ in range(self.r.randint(1, 5)))
        return f'<{(t := self.pick("section", "div", "ol"))} {self.pick("class", "id")}="{self.pick("comments", "comment-list", "responses", "disqus-thread", "replies", "reader-comments")}" {OTHER}><h3>{self.words(2)}</h3>{inner}</{t}>'

    def footer(self) -> str:
        inner = self.pick(f"&copy; {self.words(3)} &middot; {self.words(self.r.randint(5, 25))}", f"<p>&copy; {self.words(8)}</p><ul>{self.links(4)}</ul>")
        return self.pick(f"<footer {OTHER}>{inner}</footer>", f"<footer {OTHER}>{inner}</footer>", f'<div {self.pick("id", "class")}="{self.pick("footer", "site-footer", "copyright", "legal")}" {OTHER}>{inner}</div>')

    def notice(self) -> str:
        return f'<div {self.pick("class", "id")}="{self.pick("notice", "cookie-banner", "cookie-consent", "alert", "gdpr-notice")}" {OTHER}><p>{self.words(self.r.randint(4, 30))}</p><button>{self.words(1)}</button></div>'

    def main(self) -> str:
        inner = self.body_blocks()
        kind = self.r.random()
        if kind < 0.45:
            return f"<article {MAIN}>{inner}</article>"
        if kind < 0.6:
            return f"<main {MAIN}>{inner}</main>"
        if kind < 0.7:
            return f'<main><article {MAIN}>{inner}</article></main>'
        if kind < 0.95:
            return f'<div {self.pick("class", "class", "id")}="{self.pick("content", "post", "entry-content", "article-body", "story", "post-body", "main-text", "page-content")}" {MAIN}>{inner}</div>'
        return f"<div {MAIN}>{inner}</div>"

    def page(self) -> str:
        out = [self.r.choice([self.navigation, self.header, self.notice, self.aside, self.form])() for _ in range(self.r.randint(0, 4))]
        out.append(self.main())
        out += [self.r.choice([self.sidebar, self.comments, self.aside, self.form, self.navigation])() for _ in range(self.r.randint(0, 3))]
        if self.r.random() < 0.85:
            out.append(self.footer())
        if self.r.random() < 0.2:
            out.insert(0, self.sidebar())
        inner = "".join(out)
        if self.r.random() < 0.3:
            inner = f'<div {self.pick("id", "class")}="{self.pick("wrapper", "page", "container", "site", "layout")}">{inner}</div>'
        page = f"<!DOCTYPE html><html><head><title>{self.words(5)}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{inner}</body></html>"
        return page[: self.r.randint(len(page) // 2, len(page))] if self.r.random() < 0.1 else page
