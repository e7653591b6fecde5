"""Main text of web pages by a linear-chain conditional random field.

A page is read as the sequence of its leaf blocks, the runs of text between the
borders of block elements. Features of a block are its ancestors' tags and names
and the shape of its text; the field has one weight per feature and one per pair
of neighbouring labels, is trained on labelled pages by the gradient of the
conditional likelihood, and labels a page by the Viterbi path.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.llm.labelled_pages import labelled_pages

TRAINING_PAGES = 400
EPOCHS = 12
RATE = 0.3
DECAY = 1e-4
LEAST_PAGES = 4  # training pages a feature must occur on

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_RAW = re.compile(r"<(script|style|textarea|iframe)(?=[\s/>])", re.I)
_TITLE = re.compile(r"<title(?=[\s/>])", re.I)
_TITLE_END = re.compile(r"</title\s*>|</title|(?=</head|<body)", re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_UNQUOTED = re.compile(r"[^>\"']*")
_TEXT = re.compile(r"[^<]+")
_NAMES = re.compile(r"\b(class|id|role|hidden|aria-hidden|data-label)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math object param q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What a start tag ends, if that is still open.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
#: Elements whose start does not end an open paragraph's ancestors beyond them.
SCOPES = frozenset("table ul ol dl td th body html article section main div form blockquote aside nav".split())
#: Elements whose content a browser does not show, or shows as a picture or a field.
UNSEEN = frozenset("svg noscript template select annotation annotation-xml".split())
#: Start tags that end an svg or math element still open, as no such element has these names.
MARKUP = SCOPES | frozenset(
    "b big br center code dd dt em embed h1 h2 h3 h4 h5 h6 head header footer figure hr i img li main menu meta nobr ol "
    "p pre ruby s small span strike strong sub sup tr tt u var".split()
)
#: Elements of an svg that may hold markup.
GUESTS = frozenset("foreignobject desc title".split())
SECTIONS = frozenset("article main nav header footer aside form section figure table blockquote ul ol pre".split())


class Scanner:
    """The tokens of a page, read once from left to right.

    What a search found, or that it found nothing, is kept for later tags, so
    that tags, quotes and titles that never close cost no more than others.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self._ahead: dict[object, tuple[int, int, re.Match | None]] = {}
        self._lost: set[int] = set()  # places outside quotes from which no tag ends

    def _next(self, pattern: re.Pattern, at: int) -> re.Match | None:
        """The first match from ``at`` on; a match found from an earlier place is taken again while it lies ahead."""
        since, start, hit = self._ahead.get(pattern, (len(self.page) + 1, 0, None))
        if not (since <= at and (hit is None or at <= start)):
            hit = pattern.search(self.page, at)
            self._ahead[pattern] = (at, hit.start() if hit else 0, hit)
        return hit

    def _find(self, mark: str, at: int) -> int:
        since, start, _ = self._ahead.get(mark, (len(self.page) + 1, 0, None))
        if not (since <= at and (start < 0 or at <= start)):
            start = self.page.find(mark, at)
            self._ahead[mark] = (at, start, None)
        return start

    def tag_end(self, at: int) -> int:
        """Place of the bracket that ends a tag; one in quotes does so only if no other does, -1 if there is none."""
        page, place, passed = self.page, at, []
        while True:
            place = _UNQUOTED.match(page, place).end()
            if page[place : place + 1] == ">":
                return place
            close = self._find(page[place], place + 1) if place < len(page) else -1
            if close < 0 or close + 1 in self._lost:
                self._lost.update(passed)
                return self._find(">", at)
            place = close + 1
            passed.append(place)

    def tokens(self) -> Iterator[tuple[str, int, str, str, str]]:
        """Kind ("text", "field", "skip", "open" or "close"), end, text, name and attributes."""
        page, at = self.page, 0
        while at < len(page):
            if page[at] != "<":
                end = _TEXT.match(page, at).end()
                yield "text", end, page[at:end], "", ""
                at = end
                continue
            if page.startswith("<!--", at):
                at = _COMMENT.match(page, at).end()
                continue
            bracket = self._find(">", at)
            if bracket < 0:  # no tag is whole from here on
                yield "text", at + 1, "<", "", ""
                at += 1
            elif hit := _RAW.match(page, at):
                ends = _RAW_ENDS[hit[1].lower()].search(page, bracket + 1)
                at = ends.end() if ends else len(page)
                yield ("skip" if hit[1].lower() in ("script", "style") else "field"), at, "", "", ""
            elif _TITLE.match(page, at):
                ends = self._next(_TITLE_END, bracket + 1)
                whole = ends is not None and ends[0].lower() != "</title"
                at = ends.end() if whole else self._find("<", bracket + 1)
                at = len(page) if at < 0 else at
            elif hit := _TAG.match(page, at):
                end = self.tag_end(hit.end())
                yield ("close" if hit[1] else "open"), end + 1, "", hit[2].lower(), page[hit.end() : end]
                at = end + 1
            elif page[at + 1 : at + 2] in ("!", "?", "/"):
                at = bracket + 1
            else:
                yield "text", at + 1, "<", "", ""
                at += 1


_RAW_ENDS = {
    name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in ("script", "style", "textarea", "iframe")
}


class Block:
    __slots__ = ("path", "text", "linked", "label")

    def __init__(self, path: list[tuple[str, tuple[str, ...], str | None]], text: str, linked: int) -> None:
        self.path, self.text, self.linked = path, text, linked
        self.label = next((label for _, _, label in reversed(path) if label), None)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order, with white space turned into single spaces.

    All that may stand in a head holds no text, so the head needs no end. An
    unseen element that is not closed ends with the element around it; one whose
    end tag is nowhere behind it hides nothing.
    """
    stack: list[tuple[str, tuple[str, ...], str | None]] = []
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    inside_link = inside_math = False
    unseen: list[str] = []  # an unseen element and those open in it
    last: dict[str, int] = {}

    def closed(tag: str, at: int) -> bool:
        if tag not in last:
            ends = re.finditer(rf"</{tag}(?=[\s/>])", page, re.I)
            last[tag] = max((end.start() for end in ends), default=-1)
        return last[tag] >= at

    def still_unseen(slash: str, tag: str, attributes: str) -> bool:
        """Take a tag met in an unseen element; false if that element had ended before it."""
        if tag in ("head", "body", "html"):
            unseen.clear()
        elif slash:
            if tag in unseen:
                while unseen.pop() != tag:
                    pass
                return True
            if any(tag == name for name, _, _ in stack):
                unseen.clear()
        elif unseen[0] == "svg" and tag in MARKUP and not GUESTS.intersection(unseen):
            unseen.clear()
        elif unseen[0] == tag and tag in ("select", "noscript"):
            unseen.clear()
        elif tag not in VOID and not (unseen[0] == "svg" and attributes.endswith("/")):
            unseen.append(tag)
        return bool(unseen)

    def finish() -> None:
        nonlocal inside_link
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                link = len("".join("".join(linked).split()))
                out.append(Block(list(stack), text, link))
            parts.clear()
            linked.clear()
        inside_link = False

    def close(tags: set[str] | frozenset[str], scopes: frozenset[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in scopes:
                return

    for kind, end, text, tag, attributes in Scanner(page).tokens():
        if kind == "field" and not unseen:
            finish()
        elif kind == "text" and not unseen:
            parts.append(text)
            if inside_link:
                linked.append(text)
        if not tag:
            continue
        slash = "/" if kind == "close" else ""
        if unseen and still_unseen(slash, tag, attributes) or tag == "head":
            continue
        if tag in UNSEEN:
            if not slash and not attributes.endswith("/") and closed(tag, end):
                unseen.append(tag)
            if tag == "select":
                finish()
            continue
        if inside_math and (tag in MARKUP or slash and any(tag == name for name, _, _ in stack)):
            inside_math = False
        if tag == "math":
            inside_math = not slash and not attributes.endswith("/")
        if tag in INLINE or inside_math:
            if tag == "a":
                inside_link = not slash
            elif tag == "br":
                parts.append(" ")
            continue
        finish()
        if slash:
            close({tag}, frozenset())
        elif tag not in VOID:
            if tag in ENDS:
                close(ENDS[tag], frozenset({"ul", "ol", "dl", "table", "select"}))
            else:
                close({"p"}, SCOPES)
            names, label = (), None
            if attributes and "=" in attributes or "hidden" in (attributes or ""):
                found = []
                for name, *values in _NAMES.findall(attributes):
                    value = next((v for v in values if v), "")
                    if name.lower() == "data-label":
                        label = value
                    elif name.lower() in ("hidden", "aria-hidden"):
                        found += [] if value.lower() == "false" else ["hidden"]
                    else:
                        found += [part.lower() for part in _PARTS.findall(value)]
                names = tuple(dict.fromkeys(found))
            stack.append((tag, names, label))
    finish()
    return out


def _size(n: int) -> int:
    return min(n.bit_length(), 8)


Path = tuple[tuple[str, tuple[str, ...]], ...]


def path_of(block: Block) -> Path:
    return tuple((tag, names) for tag, names, _ in block.path)


def path_features(path: Path) -> list[str]:
    """Names of the features that hold for the ancestors of a block."""
    tags = [tag for tag, _ in path]
    near = next((tag for tag in reversed(tags) if tag in SECTIONS), "none")
    held = frozenset(tags)
    body = "article" in held or "main" in held
    f = ["bias", f"near={near}", f"parent={tags[-1] if tags else 'none'}", f"near={near},body={body}"]
    f += [f"in={tag}" for tag in held & SECTIONS]
    f += [f"name={name}" for name in {name for _, found in path for name in found}]
    if path:
        f += [f"own={name}" for name in set(path[-1][1])]
    # names inside the article count for more than those around it
    cut = max((i for i, tag in enumerate(tags) if tag in ("article", "main")), default=-1)
    f += {f"inner={name}" for _, found in path[cut + 1 :] for name in found}
    return f


def text_features(page: Sequence[Block], paths: Sequence[Path], at: int) -> list[str]:
    """Names of the features that hold for the text of a block and its place."""
    block, path = page[at], paths[at]
    text, words = block.text, block.text.count(" ") + 1
    share = block.linked / max(1, len(text) - words + 1)
    parent = path[-1][0] if path else "none"
    body = any(tag in ("article", "main") for tag, _ in path)
    size = _size(words)
    f = [
        f"words={size}",
        f"parent={parent},words={size}",
        f"links={min(4, int(share * 4.99))}",
        f"links={share > 0.5},body={body}",
        f"stop={text[-1] in '.!?:;'}",
    ]
    if at == 0:
        f.append("edge=first")
    if at == len(page) - 1:
        f.append("edge=last")
    if "©" in text or "opyright" in text:
        f.append("copyright")
    if at:
        f.append(f"same={paths[at - 1][:-1] == path[:-1]}")
    return f


class Field:
    """A chain of labels 0 (other) and 1 (main text)."""

    def __init__(self) -> None:
        self.places: dict[str, int] = {}
        self.weights = np.zeros(0)
        self.steps = np.zeros((2, 2))
        self._weight: dict[str, float] = {}
        self._by_path: dict[Path, float] = {}

    def _known(self) -> dict[str, float]:
        if not self._weight:
            self._weight = dict(zip(self.places, self.weights.tolist(), strict=True))
        return self._weight

    def _scores(self, found: list[list[int]]) -> list[float]:
        return [float(self.weights[f].sum()) for f in found]

    def train(self, pages: Sequence[str], epochs: int = EPOCHS, rate: float = RATE, seed: int = 1) -> Field:
        """Gradient steps, page by page, with step sizes by the gradients so far."""
        read, pages_with = [], Counter()
        for page in pages:
            held = blocks(page)
            if held:
                paths = [path_of(block) for block in held]
                rows = [path_features(path) + text_features(held, paths, i) for i, path in enumerate(paths)]
                read.append((rows, [int(block.label == "main") for block in held]))
                pages_with.update({f for row in rows for f in row})
        for f, count in sorted(pages_with.items()):
            if count >= LEAST_PAGES:
                self.places[f] = len(self.places)
        data = [
            ([np.array([self.places[f] for f in row if f in self.places], dtype=np.int64) for row in rows], labels)
            for rows, labels in read
        ]
        self.weights = np.zeros(len(self.places))
        seen, seen_steps = np.full(len(self.places), 1e-6), np.full((2, 2), 1e-6)
        draw = random.Random(seed)
        for _ in range(epochs):
            draw.shuffle(data)
            for found, labels in data:
                chances, pairs = self._expected(self._scores(found))
                gradient = np.zeros(0)
                places = np.concatenate(found)
                wrong = np.repeat([y - p for y, p in zip(labels, chances, strict=True)], [len(f) for f in found])
                used, inverse = np.unique(places, return_inverse=True)
                gradient = np.bincount(inverse, weights=wrong) - DECAY * self.weights[used]
                seen[used] += gradient**2
                self.weights[used] += rate * gradient / np.sqrt(seen[used])
                real = np.zeros((2, 2))
                for a, b in zip(labels, labels[1:], strict=False):
                    real[a, b] += 1
                step = real - pairs - DECAY * self.steps
                seen_steps += step**2
                self.steps += rate * step / np.sqrt(seen_steps)
        return self

    def _expected(self, scores: list[float]) -> tuple[list[float], np.ndarray]:
        """Chance of label 1 at each place, and expected counts of neighbouring labels."""
        t = self.steps

        def both(a: float, b: float) -> float:
            top = max(a, b)
            return top + math.log1p(math.exp(min(a, b) - top))

        n = len(scores)
        ahead = [(0.0, scores[0])]
        for s in scores[1:]:
            a, b = ahead[-1]
            ahead.append((both(a + t[0, 0], b + t[1, 0]), s + both(a + t[0, 1], b + t[1, 1])))
        back = [(0.0, 0.0)] * n
        for i in range(n - 2, -1, -1):
            a, b = back[i + 1]
            one = b + scores[i + 1]
            back[i] = (both(a + t[0, 0], one + t[0, 1]), both(a + t[1, 0], one + t[1, 1]))
        whole = both(*ahead[-1])
        chances = [math.exp(min(0.0, f[1] + b[1] - whole)) for f, b in zip(ahead, back, strict=True)]
        pairs = np.zeros((2, 2))
        for i in range(n - 1):
            for x in (0, 1):
                for y in (0, 1):
                    pairs[x, y] += math.exp(
                        min(0.0, ahead[i][x] + t[x, y] + (scores[i + 1] if y else 0.0) + back[i + 1][y] - whole)
                    )
        return chances, pairs

    def labels(self, page: Sequence[Block]) -> list[int]:
        """The most likely labels of all blocks together (Viterbi)."""
        if not page:
            return []
        known, weights, paths = self._known(), self._by_path, [path_of(block) for block in page]
        scores = []
        for i, path in enumerate(paths):
            score = weights.get(path)
            if score is None:
                if len(weights) > 20_000:
                    weights.clear()
                score = weights[path] = sum(known.get(f, 0.0) for f in path_features(path))
            scores.append(score + sum([known.get(f, 0.0) for f in text_features(page, paths, i)]))
        (t00, t01), (t10, t11) = self.steps.tolist()
        a, b, came = 0.0, scores[0], []
        for s in scores[1:]:
            came.append((a + t00 < b + t10, a + t01 < b + t11))
            a, b = max(a + t00, b + t10), s + max(a + t01, b + t11)
        out = [int(b > a)]
        for step in reversed(came):
            out.append(int(step[out[-1]]))
        return out[::-1]

    def text(self, page: str | None) -> str:
        """The blocks of main text, one per line; empty for an empty or missing page."""
        held = blocks(page) if page else []
        return "\n".join(block.text for block, label in zip(held, self.labels(held), strict=True) if label)


def trained(pages: Sequence[str] | None = None) -> Field:
    """A field trained on labelled pages; by default on a fixed number of composed ones."""
    field = Field().train(labelled_pages(TRAINING_PAGES) if pages is None else pages)
    field.weights = field.weights.round(6)
    return field


def main_text(html: Column, field: Field) -> Column:
    """The main text of a column of whole pages.

    Scripts, styles, comments in the markup, titles, pictures drawn in the page
    (svg), unshown elements and form fields hold no blocks. A page
    whose markup is broken is read as far as tags can be told; unclosed elements
    end where an outer one does. Repeated pages are treated alike.
    """

    @F.pandas_udf("string")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([field.text(page) for page in pages], dtype=object)

    return compute(html)
