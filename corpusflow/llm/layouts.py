"""Labelled pages for the main-text model: made-up pages of many layouts, each with the text that a reader came for.

A page draws a theme: the elements and class names of its parts, what parts it has, how deep its article lies and how careless its markup is. Words
are made up, so the model learns from elements, names, lengths, links and punctuation, not from a language.
"""

from __future__ import annotations

import html
import random

# What parts of pages are called.
NAMES = {
    "menu": ["nav", "navbar", "menu", "main-menu", "navigation", "breadcrumb", "breadcrumbs", "topnav", "pagination", "toc"],
    "head": ["header", "site-header", "masthead", "page-header", "topbar", "branding", "logo", "banner"],
    "foot": ["footer", "site-footer", "page-footer", "copyright", "colophon", "legal", "imprint"],
    "side": ["sidebar", "side", "aside", "widget", "related", "recommended", "most-read", "tags", "archive", "left-column"],
    "notice": ["cookie", "cookie-notice", "cookie-banner", "consent", "notice", "alert", "gdpr", "newsletter", "paywall", "popup", "modal"],
    "advert": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "banner-ad", "adsbox", "sponsor"],
    "form": ["search", "search-form", "login", "subscribe", "signup", "contact-form"],
    "share": ["share", "social", "sharing", "follow", "share-buttons"],
    "comments": ["comments", "comment-list", "discussion", "responses", "disqus", "replies", "user-comments"],
    "main": ["content", "main", "article", "post", "entry", "entry-content", "article-body", "story", "post-content", "main-content", "text", "body-text", ""],
    "plain": ["wrapper", "container", "row", "page", "inner", "col", "block", "box", "section", ""],
}
TAGS = {
    "menu": ["nav", "nav", "div", "ul", "section"], "head": ["header", "header", "div"], "foot": ["footer", "footer", "div"], "side": ["aside", "aside", "div", "section"], "notice": ["div", "section", "dialog", "p", "aside"],
    "advert": ["div", "div", "aside", "ins", "section"], "form": ["form"], "share": ["div", "ul"], "comments": ["section", "div", "div"], "main": ["article", "article", "main", "div", "section", "td"], "plain": ["div", "section", "div"],
}
SYLLABLES = ["an", "er", "ion", "the", "st", "ou", "re", "ble", "én", "ß", "ka", "mo", "ти", "на", "li", "to", "qu", "ö"]
ENTITIES = ["&amp;", "&nbsp;", "&eacute;", "&#8212;", "&quot;", "&lt;", "&hellip;", "&#x27;"]


class Writer:
    """Writes one page and notes the text of its article."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.careless = self.r.random() < 0.4
        self.vocabulary = ["".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 4))) for _ in range(300)]
        self.text: list[str] = []
        #: How the words of the article look: prose, or what corpora are full of besides.
        self.style = self.r.choice(["prose"] * 8 + ["bars", "noise", "again", "capitals", "numbers"])

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.r.choice(self.vocabulary) for _ in range(self.r.randint(lo, hi)))

    def prose(self, lo: int, hi: int) -> str:
        """Sentences of the article."""
        text, style = self.sentences(lo, hi), self.style if self.r.random() < 0.6 else "prose"
        if style == "bars":
            return text.replace(" ", " | ") + self.r.choice(["", " |"])
        if style == "noise":
            return " ".join(w + self.r.choice(["###", "%%%", "***", "$$$"]) for w in text.split(" "))
        if style == "again":
            return " ".join([self.words(1, 1).capitalize()] * self.r.randint(3, 60))
        if style == "capitals":
            return text.upper()
        if style == "numbers":
            return " ".join(self.r.choice([w, str(self.r.randint(0, 9999))]) for w in text.split(" "))
        return text

    def sentences(self, lo: int, hi: int) -> str:
        marks = self.r.choice([".", ".", ".", "!", "?", ""])
        return " ".join(self.words(self.r.choice([1, 3, 3, 3]), 22).capitalize().replace(" ", self.r.choice([" ", ", "]), 1) + (marks or ".") for _ in range(self.r.randint(lo, hi)))

    def open(self, part: str, named: float = 0.75) -> tuple[str, str]:
        tag, name = self.r.choice(TAGS[part]), self.r.choice(NAMES[part])
        kind = self.r.choice(["class", "class", "id"])
        has = name and (self.r.random() < named or tag in ("div", "section", "p", "ul", "td", "ins", "aside") and part not in ("main", "plain"))
        return f"<{tag}" + (f' {kind}="{name}"' if has else "") + ">", f"</{tag}>"

    def links(self, n: int, short: bool = True) -> str:
        items = [f'<a href="/{i}">{self.words(1, 2 if short else 9).capitalize()}</a>' for i in range(n)]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if self.r.random() < 0.7 else self.r.choice([" | ", " &middot; ", " ", "<br>"]).join(items)

    def part(self, part: str) -> str:
        r = self.r
        a, b = self.open(part)
        if part in ("menu", "side", "share"):
            inner = (f"<h3>{self.words(1, 3)}</h3>" if r.random() < 0.4 and part == "side" else "") + self.links(r.randint(2, 12), part != "side")
            if part == "side" and r.random() < 0.3:
                inner += f"<p>{self.sentences(1, 2)}</p>"
        elif part == "head":
            inner = r.choice([f"<h1>{self.words(1, 3)}</h1>", f"<div>{self.words(1, 3)}</div>", f'<a href="/">{self.words(1, 2)}</a>']) + (f"<p>{self.words(2, 8)}</p>" if r.random() < 0.4 else "")
        elif part == "foot":
            inner = r.choice(["&copy; ", "© 2024 ", ""]) + self.words(1, 6) + r.choice(["", " &middot; " + self.sentences(1, 2), "<p>" + self.words(3, 12) + "</p>" + self.links(3)])
        elif part == "form":
            inner = f'<label>{self.words(1, 3)}</label><input type="text" value="{self.words(1, 1)}"><select><option>{self.words(1, 1)}<option>{self.words(1, 1)}</select><button>{self.words(1, 2)}</button>'
        elif part == "comments":
            one = [f'<div class="{r.choice(["comment", "reply", "comment-body", "c"])}"><b>{self.words(1, 2)}</b><p>{self.sentences(1, 4)}</p></div>' for _ in range(r.randint(1, 6))]
            inner = f"<h3>{self.words(1, 3)}</h3>" + "".join(one)
        else:  # notices and adverts look like prose
            inner = self.sentences(1, 3) + (f' <a href="#">{self.words(1, 3)}</a>' if r.random() < 0.5 else "") + (f"<button>{self.words(1, 2)}</button>" if part == "notice" and r.random() < 0.5 else "")
        return a + inner + b

    def inline(self, text: str) -> str:
        out = []
        for w in text.split(" "):
            x = self.r.random()
            w = html.escape(w, quote=False)
            out.append(f'<a href="/x">{w}</a>' if x < 0.015 else f"<b>{w}</b>" if x < 0.03 else f"<em>{w}</em>" if x < 0.04 else w + self.r.choice(ENTITIES) if x < 0.05 else w)
        return self.r.choice([" ", " ", "\n"]).join(out)

    def said(self, markup: str) -> str:
        """Markup of one block of the article, whose text is noted."""
        plain = "".join(x.split(">", 1)[-1] for x in ("<>" + markup).split("<")[1:])
        self.text.append(" ".join(html.unescape(plain).split()))
        return markup

    def block(self) -> str:
        x, end = self.r.random(), "" if self.careless and self.r.random() < 0.5 else "</p>"
        if x < 0.72:
            return "<p>" + self.said(self.inline(self.prose(1, 7))) + end
        if x < 0.76:
            return "<p>" + self.said(self.inline(self.words(1, 6)) + ".") + end
        if x < 0.84:
            return f"<h2>{self.said(self.words(1, 8))}</h2>"
        if x < 0.9:
            return "<ul>" + "".join(f"<li>{self.said(self.inline(self.words(1, 15)))}" + ("" if self.careless else "</li>") for _ in range(self.r.randint(1, 6))) + "</ul>"
        if x < 0.94:
            return "<blockquote><p>" + self.said(html.escape(self.prose(1, 3), quote=False)) + "</p></blockquote>"
        if x < 0.97:
            return "<table><tr>" + "".join(f"<td>{self.said(self.words(1, 4))}</td>" for _ in range(self.r.randint(2, 6))) + "</tr></table>"
        return "<pre>" + self.said(self.words(5, 30)) + "</pre>"

    def article(self) -> str:
        r = self.r
        a, b = self.open("main", 0.6)
        if a.startswith("<td"):
            a, b = "<table><tr>" + a, b + "</tr></table>"
        out = [f"<h1>{self.said(self.words(2, 12))}</h1>"] if r.random() < 0.85 else []
        loose = r.random() < 0.1  # paragraphs parted by empty lines of <br> only in their own div
        n = r.choice([1, 1, 1, 2, 2, 3, 5, 8, 13, 20])
        for k in range(n):
            out.append("<div>" + self.said(self.inline(self.prose(1, 6))) + "</div>" if loose else self.block())
            if k < n - 1 and r.random() < 0.06:
                out.append(self.part(r.choice(["advert", "side", "share", "notice", "form"])))
        if self.careless and r.random() < 0.3:
            out.append("<!-- " + self.words(1, 5) + " -->")
        tail = "".join(self.part(p) for p in ("share", "side", "comments") if r.random() < 0.12)
        return a + "".join(out) + tail + b

    def page(self) -> tuple[str, str]:
        r = self.r
        before = [p for p in ("notice", "head", "menu", "form", "advert", "side") if r.random() < 0.5]
        after = [p for p in ("side", "comments", "advert", "share", "notice", "form", "foot") if r.random() < (0.85 if p == "foot" else 0.35)]
        body = "".join(self.part(p) for p in before) + self.article() + "".join(self.part(p) for p in after)
        for _ in range(r.choice([0, 0, 1, 2, 3])):
            a, b = self.open("plain", 0.7)
            body = a + body + b
        head = f'<head><meta charset="utf-8"><title>{self.words(2, 9)}</title><style>p{{margin:0}}</style><script>var t="</p><div>";</script></head>'
        return f"<!DOCTYPE html><html>{head}<body>{body}" + ("" if r.random() < 0.1 else "</body></html>"), "\n\n".join(t for t in self.text if t)


def labelled(seed: int) -> tuple[str, str]:
    """A page and the main text of it."""
    return Writer(seed).page()
