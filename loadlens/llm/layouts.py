"""Labelled page layouts, made from a seed, to fit the extraction model on.

No table of the corpus labels its pages, so the model learns from pages that
are put together here: one main text with paragraphs, headings, lists, quotes
and tables, and around or inside it menus, headers, sidebars, adverts,
notices, forms, link lists, reader comments and footers, under many names and
nestings. ``data-keep`` marks the label; the features never see it.
"""

from __future__ import annotations

import random

_SYLLABLES = "an ber co de en fa go hi ir ja ka lo mi nu or pa que ra se ti un ver wo xi ya zo é ü ción the".split()
_PLAIN = ["css-1x2y", "row", "col-8", "wrap", "container", "inner", "box", "x1", "block", "grid"]
_MAIN = ["content", "post-content", "article-body", "entry", "story", "main", "post", "page-content", "entry-content"]
_NOISE = {
    "menu": ["nav", "menu", "navbar", "main-menu", "site-nav"],
    "header": ["header", "site-header", "masthead", "banner", "topbar"],
    "sidebar": ["sidebar", "widget", "aside", "right-rail", "side"],
    "advert": ["ad", "ads", "advert", "sponsored", "promo", "ad-slot", "advertisement"],
    "notice": ["cookie-notice", "notice", "alert", "consent", "gdpr", "popup", "modal"],
    "form": ["newsletter", "subscribe", "signup", "search", "login-form"],
    "links": ["related", "recommended", "more", "popular", "share", "social", "tags", "breadcrumbs", "pagination"],
    "comments": ["comments", "comment-list", "discussion", "replies", "disqus"],
    "footer": ["footer", "site-footer", "copyright", "legal"],
}
_TAGS = {
    "menu": ["nav", "div", "nav", "ul"], "header": ["header", "div"], "sidebar": ["aside", "div"], "advert": ["div", "div", "aside"],
    "notice": ["div", "section", "dialog", "p"], "form": ["form", "form", "div"], "links": ["div", "section", "aside", "ul", "nav"],
    "comments": ["section", "div", "ol"], "footer": ["footer", "footer", "div"],
}


class _Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(lo, hi)))

    def sentences(self, lo: int, hi: int) -> str:
        out = []
        for _ in range(self.r.randint(lo, hi)):
            s = self.words(1, 18).capitalize()
            out.append((s.replace(" ", ", ", 1) if self.r.random() < 0.4 else s) + self.r.choice("....!?"))
        if self.r.random() < 0.15:
            k = self.r.randrange(len(out))
            out[k] = f'<a href="/{self.word()}">{out[k]}</a>' if self.r.random() < 0.5 else f"<b>{out[k]}</b>"
        if self.r.random() < 0.1:
            out = [s + self.r.choice([" ###", "*** %%%", " &amp;&amp;", " | " + self.word()]) for s in out]
        return " ".join(out)

    def tag(self, name: str, keep: bool, body: str, marks: list[str] | None = None) -> str:
        r, attributes = self.r, ""
        if marks:
            attributes += f' {r.choice(["class", "class", "id"])}="{r.choice(marks)}"'
        elif r.random() < 0.2:
            attributes += f' class="{r.choice(_PLAIN)}"'
        end = "" if name in ("p", "li") and r.random() < 0.15 else f"</{name}>"
        return f'<{name}{attributes} data-keep="{int(keep)}">{body}{end}'

    def list_of_links(self, keep: bool = False) -> str:
        items = "".join(
            self.tag("li", keep, f'<a href="/{self.word()}">{self.words(1, 3 if self.r.random() < 0.7 else 9)}</a>')
            for _ in range(self.r.randint(2, 9))
        )
        return self.tag("ul", keep, items)

    def noise(self, kind: str) -> str:
        r = self.r
        name, marks = r.choice(_TAGS[kind]), _NOISE[kind] if r.random() < 0.85 or kind in ("comments", "advert", "notice") else None
        if kind in ("menu", "links"):
            inner = self.list_of_links() if r.random() < 0.6 else " ".join(f'<a href="#">{self.words(1, 4)}</a>' for _ in range(r.randint(1, 8)))
            if kind == "links" and r.random() < 0.5:
                inner = self.tag("h3", False, self.words(1, 3)) + inner
        elif kind == "comments":
            inner = "".join(
                self.tag("div", False, self.tag("p", False, self.sentences(1, 5)) + (f"<span>{self.word()}</span>" if r.random() < 0.5 else ""))
                if r.random() < 0.5 else self.tag("p", False, self.sentences(1, 4))
                for _ in range(r.randint(1, 6))
            )
            if r.random() < 0.5:
                inner = self.tag("h3", False, self.words(1, 2)) + inner
        elif kind == "form":
            inner = f'<label>{self.words(1, 3)}</label><input name="q"><button>{self.word()}</button>'
            if r.random() < 0.5:
                inner = self.tag("p", False, self.sentences(1, 1)) + inner
        elif kind == "header":
            inner = r.choice([f'<a href="/">{self.words(1, 3)}</a>', self.tag("h1", False, self.words(1, 3)), self.words(1, 6)])
            if r.random() < 0.4:
                inner += self.noise("menu")
        elif kind == "sidebar":
            inner = "".join(r.choice([self.list_of_links, lambda: self.tag("p", False, self.sentences(1, 3)), lambda: self.words(2, 9)])() for _ in range(r.randint(1, 3)))
        elif kind == "footer":
            inner = f"&copy; {self.words(1, 3)}" + r.choice(["", " &middot; " + self.sentences(1, 2), self.list_of_links(), self.tag("p", False, self.sentences(1, 2))])
        else:  # advert, notice
            inner = r.choice([self.sentences(1, 3), self.tag("p", False, self.sentences(1, 2)), f'<a href="/x">{self.words(2, 8)}</a>'])
        return self.tag(name, False, inner, marks)

    def main_blocks(self) -> list[str]:
        r, out = self.r, []
        if r.random() < 0.85:
            out.append(self.tag("h1", True, self.words(1, 10).capitalize() + r.choice(["", "."])))
        for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14])):
            roll = r.random()
            if roll < 0.68:
                out.append(self.tag("p", True, self.sentences(1, r.choice([1, 2, 4, 8]))))
            elif roll < 0.76:
                out.append(f'<p data-keep="1"><b>{self.sentences(1, 2)}<br>')
            elif roll < 0.84:
                out.append(self.tag("h2", True, self.words(1, 8).capitalize()))
            elif roll < 0.89:
                out.append(self.tag("ul", True, "".join(self.tag("li", True, self.sentences(1, 2)) for _ in range(r.randint(2, 5)))))
            elif roll < 0.92:
                out.append(self.tag("blockquote", True, self.tag("p", True, self.sentences(1, 3))))
            elif roll < 0.94:
                cells = "".join(self.tag("td", True, self.words(1, 3)) for _ in range(3))
                out.append(self.tag("table", True, "".join(self.tag("tr", True, cells) for _ in range(r.randint(1, 4)))))
            elif roll < 0.97:
                out.append(self.tag("pre", True, self.words(3, 30)))
            else:
                out.append(self.tag("div", True, self.sentences(1, 4)))
        return out

    def page(self) -> str:
        r = self.r
        blocks = self.main_blocks()
        for kind in ("advert", "links", "form", "notice"):
            if r.random() < 0.15:
                blocks.insert(r.randint(1, len(blocks)), self.noise(kind))
        body = "".join(blocks)
        if r.random() < 0.35:
            body = self.tag("div", True, body, r.choice([_MAIN, _PLAIN]))
        if r.random() < 0.15:
            body += self.noise("comments")
        body = self.tag(r.choice(["article", "article", "main", "div", "section"]), True, body, r.choice([_MAIN, None, _MAIN]))
        if r.random() < 0.2:
            body = self.tag("main", True, body)
        before = [self.noise(k) for k in ("header", "menu", "notice", "links", "advert", "form", "sidebar") if r.random() < 0.4]
        after = [self.noise(k) for k in ("comments", "links", "sidebar", "advert", "form", "notice") if r.random() < 0.3]
        after += [self.noise("footer")] if r.random() < 0.8 else []
        r.shuffle(before)
        whole = "".join(before) + body + "".join(after)
        if r.random() < 0.25:
            whole = self.tag("div", True, whole, _PLAIN)
        head = f"<head><title>{self.words(1, 6)}</title><style>p{{}}</style></head>"
        return f'<!DOCTYPE html><html data-keep="1">{head}<body data-keep="1">{whole}</body></html>'


def pages(n: int, seed: int) -> list[str]:
    """So many labelled pages."""
    maker = _Maker(seed)
    return [maker.page() for _ in range(n)]
