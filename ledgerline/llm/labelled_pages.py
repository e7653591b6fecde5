"""Labelled pages to train the main-text extractor on.

A page is labelled in its markup: the nearest ancestor with `data-label="main"`
or `data-label="other"` says what a block is. The pages are composed from a seed:
page layouts of many kinds, invented words, and every kind of block that is not
main text, with or without telling names, beside the article and inside it.
"""

from __future__ import annotations

import random

SYLLABLES = "an ba co de en fu ga hi in ja ko li me no or pa qu ra si ta un vi wo xe yl zu ch th st tr".split()

MAIN_NAMES = ["content", "main-content", "post", "entry-content", "article-body", "story", "text", "page"]
OTHER_NAMES = {
    "nav": ["nav", "menu", "navbar", "main-menu", "breadcrumb", "breadcrumbs", "toc", "pagination", "topbar"],
    "header": ["header", "site-header", "masthead", "branding", "top", "page-header"],
    "footer": ["footer", "site-footer", "copyright", "legal", "bottom", "colophon"],
    "aside": ["sidebar", "side", "widget", "related", "related-posts", "more", "rail", "tags", "teaser"],
    "notice": ["cookie", "cookie-notice", "notice", "alert", "consent", "gdpr", "banner", "popup", "modal", "message"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "ad-slot"],
    "form": ["search", "newsletter", "subscribe", "signup", "login", "contact-form"],
    "comments": ["comments", "comment-list", "comment", "replies", "discussion", "responses", "disqus"],
    "share": ["share", "social", "share-buttons", "follow"],
}
HEADINGS = {
    "aside": ["Related", "More stories", "Popular", "Tags", "Archive"],
    "comments": ["Comments", "3 comments", "Discussion", "Leave a reply"],
    "form": ["Search", "Subscribe", "Sign up", "Newsletter"],
    "notice": ["Notice", "Cookies", "We value your privacy"],
    "ad": ["Advertisement", "Sponsored"],
}


class Composer:
    def __init__(self, seed: int) -> None:
        self.draw = random.Random(seed)

    def word(self) -> str:
        return "".join(self.draw.choice(SYLLABLES) for _ in range(self.draw.choice((1, 1, 2, 2, 3, 4))))

    def words(self, low: int, high: int, stop: str = ".") -> str:
        out = [self.word() for _ in range(self.draw.randint(low, high))]
        for i in range(len(out)):
            kind = self.draw.random()
            if kind < 0.08:
                out[i] += ","
            elif kind < 0.14 and stop:
                out[i] += stop
            elif kind < 0.18:
                out[i] = f"<{(tag := self.draw.choice(['b', 'i', 'em', 'strong', 'code', 'span']))}>{out[i]}</{tag}>"
            elif kind < 0.2:
                out[i] += self.draw.choice(["&amp;", "&quot;", "%%%", "###", "!", "?", "&nbsp;"])
        return " ".join(out).capitalize() + stop

    def link(self, low: int = 1, high: int = 3) -> str:
        return f'<a href="/{self.word()}">{self.words(low, high, "")}</a>'

    def named(self, kind: str) -> str:
        """Attributes that may tell the kind of a block."""
        told = self.draw.random()
        if told < 0.2:
            return ""
        name = self.draw.choice(OTHER_NAMES.get(kind, MAIN_NAMES))
        return f' id="{name}"' if told < 0.35 else f' class="{name} {self.word()}"' if told < 0.6 else f' class="{name}"'

    def wrapped(self, kind: str, tags: list[str], inside: str) -> str:
        tag = self.draw.choice(tags)
        name = self.named(kind)
        if tag == "div" and not name and kind not in ("nav", "share"):  # nothing else would tell
            name = f' class="{self.draw.choice(OTHER_NAMES[kind])}"'
        heading = ""
        if kind in HEADINGS and self.draw.random() < 0.4:
            level = self.draw.choice(["h2", "h3", "h4"])
            heading = f"<{level}>{self.draw.choice(HEADINGS[kind])}</{level}>"
        return f'<{tag}{name} data-label="other">{heading}{inside}</{tag}>'

    def prose(self, tag: str = "p") -> str:
        size = self.draw.choice([(1, 4), (5, 20), (20, 60), (60, 150)])
        return f"<{tag}>{self.words(*size)}</{tag}>"

    def links(self) -> str:
        items = "".join(f"<li>{self.link()}</li>" for _ in range(self.draw.randint(2, 9)))
        return f"<ul>{items}</ul>" if self.draw.random() < 0.8 else " | ".join(self.link() for _ in range(4))

    def other(self, kind: str) -> str:
        draw = self.draw
        if kind == "nav":
            return self.wrapped(kind, ["nav", "nav", "div"], self.links())
        if kind == "header":
            title = draw.choice(["h1", "h2", "div", "p", "span"])
            inside = f"<{title}>{self.words(1, 5, '')}</{title}>" + draw.choice(["", self.links(), self.prose()])
            return self.wrapped(kind, ["header", "header", "div"], inside)
        if kind == "footer":
            text = draw.choice(["&copy; ", "", "Copyright "]) + self.words(2, 40)
            return self.wrapped(kind, ["footer", "footer", "div"], draw.choice([text, f"<p>{text}</p>", text + self.links()]))
        if kind == "aside":
            inside = draw.choice([self.links(), self.prose(), self.prose() + self.links(), f"<p>{self.link(3, 12)}</p>"])
            return self.wrapped(kind, ["aside", "aside", "div", "section"], inside)
        if kind == "ad":
            inside = draw.choice([self.words(2, 30), self.prose(), f"<p>{self.link(2, 8)}</p>"])
            return self.wrapped(kind, ["div", "div", "aside"], inside)
        if kind == "notice":
            inside = draw.choice([self.words(4, 40), self.prose()]) + draw.choice(["", f"<button>{self.words(1, 2, '')}</button>"])
            return self.wrapped(kind, ["div", "div", "aside", "section"], inside)
        if kind == "form":
            fields = f"<label>{self.words(1, 3, '')}</label><input name=q><button>{self.words(1, 2, '')}</button>"
            inside = draw.choice(["", self.prose()]) + fields
            return self.wrapped(kind, ["form"], inside) if draw.random() < 0.7 else self.wrapped(kind, ["div"], f"<form>{inside}</form>")
        if kind == "comments":
            one = "".join(
                f"<{tag}{self.named('comments')}>{draw.choice(['', f'<b>{self.words(1, 2, '')}</b>'])}{self.prose()}</{tag}>"
                for tag in [draw.choice(["div", "li", "article", "div"])] * draw.randint(1, 5)
            )
            tag = draw.choice(["div", "section", "ol"])
            return f'<{tag} class="{draw.choice(OTHER_NAMES[kind])}" data-label="other">{one}</{tag}>'
        return self.wrapped("share", ["div", "ul"], "".join(f"<li>{self.link(1, 1)}</li>" for _ in range(3)))

    def article(self) -> str:
        draw, parts = self.draw, []
        title = f"<h1>{self.words(2, 12, draw.choice(['', '.']))}</h1>"
        parts.append(f"<header>{title}</header>" if draw.random() < 0.25 else title if draw.random() < 0.9 else "")
        for _ in range(draw.choice([1, 2, 3, 5, 8, 14])):
            kind = draw.random()
            if kind < 0.62:
                parts.append(self.prose())
            elif kind < 0.70:
                parts.append(f"<p><b>{self.words(1, 80)}<br>")
            elif kind < 0.76:
                parts.append(f"<{(h := draw.choice(['h2', 'h3']))}>{self.words(1, 8, '')}</{h}>")
            elif kind < 0.82:
                items = "".join(f"<li>{self.words(1, 25)}" + draw.choice(["</li>", ""]) for _ in range(draw.randint(1, 5)))
                parts.append(f"<ul>{items}</ul>")
            elif kind < 0.86:
                parts.append(f"<blockquote>{draw.choice([self.prose(), self.words(3, 40)])}</blockquote>")
            elif kind < 0.88:
                parts.append(f"<pre>{self.words(3, 20)}</pre>")
            elif kind < 0.90:
                cells = "".join(f"<tr><td>{self.words(1, 4, '')}</td><td>{self.words(1, 6, '')}</td></tr>" for _ in range(3))
                parts.append(f"<table>{cells}</table>")
            elif kind < 0.92:
                parts.append(f"<figure><img src=x><figcaption>{self.words(2, 14)}</figcaption></figure>")
            elif kind < 0.95:
                parts.append(f"<div>{self.words(5, 60)}</div>")
            else:
                parts.append(self.other(draw.choice(["ad", "aside", "notice", "form", "share", "nav"])))
        if draw.random() < 0.15:
            parts.append(self.other("comments"))
        return "".join(parts)

    def page(self) -> str:
        draw = self.draw
        before = [kind for kind in ("notice", "header", "nav", "ad", "form", "aside") if draw.random() < 0.4]
        after = [kind for kind in ("share", "comments", "ad", "aside", "form", "notice", "nav") if draw.random() < 0.3]
        body = "".join(self.other(kind) for kind in before)
        main = self.article()
        layout = draw.random()
        if layout < 0.4:
            main = f'<article data-label="main">{main}</article>'
            main = f"<main>{main}</main>" if draw.random() < 0.4 else main
        elif layout < 0.55:
            main = f'<main data-label="main">{main}</main>'
        elif layout < 0.8:
            name = draw.choice(MAIN_NAMES)
            main = f'<div {draw.choice(["class", "id"])}="{name}" data-label="main">{main}</div>'
        elif layout < 0.9:
            main = f'<section data-label="main">{main}</section>'
        else:
            main = f'<div data-label="main">{main}</div>'
        if draw.random() < 0.3:
            main = f"<div class={self.word()}>{main}</div>"
        body += main + "".join(self.other(kind) for kind in after)
        if draw.random() < 0.8:
            body += self.other("footer")
        return (
            f"<!DOCTYPE html><html><head><title>{self.words(2, 6, '')}</title><style>p{{margin:0}}</style>"
            f'<script>var t="</p>";</script></head><body>{body}</body></html>'
        )


def labelled_pages(count: int, seed: int = 5) -> list[str]:
    return [Composer(seed * 1_000_003 + i).page() for i in range(count)]
