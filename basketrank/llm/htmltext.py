"""Main text of web pages as the maximum-scoring run of words and tags."""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pick, slices

# The HTML elements whose content is no text, those without content, and those that separate blocks.
HIDDEN = ("script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "title", "select", "textarea")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
BLOCKS = (
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
    "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
)
# A start tag ends an open element of these names; where it is not listed and starts a block, an open paragraph.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = ("ul", "ol", "dl", "table", "div", "article", "section", "main", "aside", "nav", "header", "footer", "form", "body")

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?:(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|[^>]*(?:>|\Z))",
    re.S,
)
_NAMES = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_UNSEEN = re.compile(r"(?<![\w-])hidden(?![\w-])|display\s*:\s*none", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Pages to learn from, written for this purpose: an article in different wrappers, and the parts that stand around one.
_BODY = "<h1>w w w</h1><p>w w w w w w w w <a href=/>w w</a> w w w w w</p><h2>w w</h2><p>w w <b>w</b> w w w w w w w</p><ul><li>w w w w</li><li>w w w w w</li></ul><blockquote><p>w w w w w w</p></blockquote><table><tr><td>w w</td><td>w</td></tr></table><figure><figcaption>w w w</figcaption></figure><p>w w w w w<br>w w w w w w w</p>"
# Elements that hold text themselves.
TEXTUAL = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "blockquote", "pre", "figcaption", "caption")
# Elements that shape text and say nothing about where it stands.
PLAIN = ("a", "b", "br", "div", "h1", "h2", "h3", "label", "li", "ol", "p", "section", "ul")
_WRAPPERS = (
    "<article>{}</article>", "<main><article>{}</article></main>", "<main>{}</main>", "<div class='content'>{}</div>",
    "<div id=content><div class='post'>{}</div></div>", "<div class='article-body'>{}</div>", "<div class='entry'>{}</div>",
    "<section class='story text'>{}</section>", "<div role=main>{}</div>", "<div>{}</div>", "<section>{}</section>",
)
_OTHERS = (
    "<nav><ul><li><a href=/>x</a></li><li><a href=/>x</a></li><li><a href=/>x x</a></li></ul></nav>",
    "<header><h1>x x</h1><p>x x x</p></header>", "<footer>x x x x <a href=/>x</a><p>x x</p></footer>",
    "<aside><h3>x</h3><ul><li><a href=/>x x x</a></li></ul><p>x x x x</p></aside>", "<form><label>x x</label><input><button>x</button></form>",
    "<div class='ad'>x x x x x x</div>", "<div class='ads'>x x x</div>", "<div class='advert'>x x x x</div>", "<div class='advertisement'>x x x</div>",
    "<div class='sponsored'>x x x</div>", "<div class='promo'>x x x x</div>", "<div class='banner'>x x x x</div>", "<div class='sidebar'><p>x x x x</p></div>",
    "<div class='menu'><a href=/>x</a> <a href=/>x</a></div>", "<ul class='nav'><li>x</li></ul>", "<div class='navigation'>x x</div>", "<div class='navbar'>x x</div>",
    "<div class='breadcrumb'>x x x</div>", "<ul class='breadcrumbs'><li>x</li></ul>", "<div id='header'>x x x</div>", "<div id='footer'>x x x</div>",
    "<div class='cookie notice'>x x x x x x</div>", "<div class='consent'>x x x x</div>", "<div class='cookies'>x x x</div>", "<div class='gdpr'>x x x x</div>", "<div role='alert'>x x x</div>", "<div class='notice'>x x x x x</div>",
    "<div class='popup'>x x x</div>", "<div class='modal'>x x x</div>", "<div class='newsletter'><p>x x x x</p></div>", "<div class='subscribe'>x x x</div>", "<div class='login'>x x</div>", "<div class='search'>x x</div>",
    "<section class='comments'><h2>x</h2><div class='comment'><p>x x x x x x x</p></div><div class='comment'><p>x x x x x</p></div></section>",
    "<ol class='commentlist'><li><p>x x x x x x</p></li></ol>", "<div id='disqus_thread'>x x x x</div>", "<div class='replies'><p>x x x x x</p></div>", "<div class='reply'><p>x x x x</p></div>", "<div id='respond'>x x x</div>",
    "<div class='share'>x x x</div>", "<div class='social'>x x</div>", "<div class='related'><a href=/>x x x</a></div>", "<div class='recommended'><a href=/>x x</a></div>", "<div class='tags'><a href=/>x</a></div>",
    "<div class='pagination'><a href=/>x</a></div>", "<div class='widget'><p>x x x</p></div>", "<div class='copyright'>x x x x</div>", "<div class='disclaimer'>x x x x x</div>", "<div role='navigation'>x x</div>", "<div role='banner'>x x</div>", "<div role='complementary'>x x x</div>", "<div role='contentinfo'>x x x</div>",
    "<button>x x</button>", "<menu><li>x</li></menu>", "<dialog><p>x x x</p></dialog>",
)


def signatures(name: str, attributes: str | None) -> list[str]:
    """What a start tag is known by: its name, and the words of its class, id and role."""
    return [name, *("." + part for _, tokens in _tokens(attributes) for token in tokens for part in token)]


def _tokens(attributes: str | None) -> list[tuple[str, list[list[str]]]]:
    """The class, id and role of a start tag: names separated by white space, each as its words in lower case."""
    found = _NAMES.findall(attributes) if attributes else ()
    return [(which.lower(), [[part.lower() for part in _PART.findall(token)] for token in "".join(values).split()]) for which, *values in found]


def inner_signatures(name: str, attributes: str | None) -> list[str]:
    """What a start tag is known by inside an article, where headings are anchors and paragraphs have their own topics.

    An id, and any name of an element that holds text itself, counts only as a whole.
    """
    whole = name in TEXTUAL
    return [
        name, *("." + part for which, tokens in _tokens(attributes) for token in tokens if len(token) == 1 or not (whole or which == "id") for part in token)
    ]


def last_words(attributes: str | None) -> list[str]:
    """The last word of each class: what a name like ``social-science-body`` says that an element is."""
    return ["." + token[-1] for which, tokens in _tokens(attributes) if which == "class" for token in tokens if token]


class Weights:
    """What words and tags score, from labelled pages.

    ``odds`` are log-odds that an element of a signature stands in or around an article rather than in another part.
    A signature that only other parts have marks an element as one of them.
    """

    #: What a word scores at least, what an ordinary tag takes, and what it takes to enter or leave an article or
    #: another part of the page.
    word, tag, wall = 1.0, -0.2, -12.0

    def __init__(self, pages: list[tuple[str, str]]):
        inside, outside = Counter(), Counter()
        for other, article in pages:
            for counts, part in ((inside, article), (outside, other)):
                for match in _TAG.finditer(part):
                    if match["name"] and not match["end"]:
                        counts.update(signatures(match["name"].lower(), match["more"]))
        self.odds = {key: math.log((inside[key] + 0.5) / (outside[key] + 0.5)) for key in {*inside, *outside} - {*PLAIN}}
        self.others = {key for key in outside if not inside[key]} - {*PLAIN}

    def is_other(self, keys: list[str], in_article: bool) -> bool:
        if keys[0] in ("html", "body", "main", "article"):
            return False
        return any(key in self.others and not (in_article and key in ("header", ".header")) for key in keys)

    def is_article(self, keys: list[str]) -> bool:
        return keys[0] in ("article", "main") or any(key[0] == "." and self.odds.get(key, 0.0) > 0 for key in keys)

    def bonus(self, keys: list[str]) -> float:
        return max(0.0, *(self.odds.get(key, 0.0) for key in keys))


def labelled_pages() -> list[tuple[str, str]]:
    """Pairs of (the parts around an article, the article in its wrapper)."""
    return [("".join(_OTHERS), wrapper.format(_BODY)) for wrapper in _WRAPPERS]


WEIGHTS = Weights(labelled_pages())


def events(page: str) -> list[tuple]:
    """The page in order: ``(text, None, 0, None)``, or ``(None, piece, elements it closes, what it opens)`` for a tag.

    ``piece`` stands for the tag in the text: None where a block ends. What opens is
    ``(name, keys, whether unseen, whether it stays open, attributes)``. Comments and scripts are left out.
    """
    out: list[tuple] = []
    names: list[str] = []
    # How many elements of a name are open, so that a stray end tag costs no search.
    opened: Counter = Counter()
    at = 0

    def close(wanted: tuple[str, ...], scopes: tuple[str, ...] = ()) -> int:
        """End the innermost open element of these names, within the scopes, and all in it; returns how many."""
        if not any(opened[name] for name in wanted):
            return 0
        for i in range(len(names) - 1, -1, -1):
            if names[i] in wanted:
                ended = len(names) - i
                opened.subtract(names[i:])
                del names[i:]
                return ended
            if names[i] in scopes:
                return 0
        return 0

    def add_text(raw: str) -> None:
        if raw:
            out.append((raw, None, 0, None))

    while match := _TAG.search(page, at):
        add_text(page[at : match.start()])
        at = match.end()
        if match["cdata"]:
            add_text(match["cdata"])
        if not match["name"]:
            continue
        name = match["name"].lower()
        piece = None if name in BLOCKS else " " if name == "br" else ""
        if match["end"]:
            out.append((None, piece, close((name,)), ("", (), False, False, None)))
            continue
        if name in HIDDEN:
            if not match[0].endswith("/>"):
                end = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
                at = end.start() if end else len(page)
            out.append((None, piece, 0, ("", (), False, False, None)))
            continue
        ended = close(ENDS.get(name, ("p",)), SCOPES) if name in ENDS or name in BLOCKS else 0
        unseen = bool(match["more"]) and _UNSEEN.search(match["more"]) is not None
        stays = name not in VOID and not match[0].endswith("/>")
        out.append((None, piece, ended, (name, signatures(name, match["more"]), unseen, stays, match["more"])))
        if stays:
            names.append(name)
            opened[name] += 1
    add_text(page[at:])
    return out


def wrappers(found: list[tuple], weights: Weights = WEIGHTS) -> set[int]:
    """Numbers of the elements (in the order they open) that stand around the page's article, whatever they are called.

    The article is the ``article`` or ``main`` with the most words, halved for every element around it that is named
    like another part, and the one of them within it that has most of its words; failing both names, an element with
    a word that articles have. On a page without any, an element with more than half of the page's words is a wrapper.
    So is one inside the article that holds most of its words, if a class of it ends in a word that articles have.
    """
    # (words before it, other parts around it, kind: 2 by its name, 1 by its words, 0 none); bounds are set at its end.
    elements: list[tuple[int, int, int]] = []
    ends: list[tuple[int, int]] = []
    stack: list[tuple[int, bool, bool]] = []
    named: list[int] = []
    bodies: set[int] = set()
    words = others = hidden = 0

    def close(ended: int) -> None:
        nonlocal others, hidden
        for number, other, unseen in stack[len(stack) - ended :]:
            ends[number] = (words, len(elements))
            others -= other
            hidden -= unseen
        del stack[len(stack) - ended :]

    for text, _, ended, opens in found:
        if text is not None:
            words += 0 if hidden else len(text.split())
            continue
        close(ended)
        name, keys, unseen, stays, attributes = opens
        if stays:
            other = weights.is_other(keys, False)
            if other and any(weights.odds.get(key, 0.0) > 0 for key in last_words(attributes)):
                bodies.add(len(elements))
            kind = 2 if name in ("article", "main") else 1 if not other and weights.is_article(keys) else 0
            if other:
                named.append(len(elements))
            stack.append((len(elements), other, unseen))
            elements.append((words, others, kind))
            ends.append((0, 0))
            others += other
            hidden += unseen
    close(len(stack))

    def size(i: int) -> int:
        return ends[i][0] - elements[i][0]

    kind = max((kind for *_, kind in elements), default=0)
    if not kind:
        return {i for i in named if 2 * size(i) > words}
    marks = [i for i, (*_, own) in enumerate(elements) if own == kind]
    article = max(marks, key=lambda i: size(i) / 2 ** elements[i][1])
    for i in marks:
        if article < i < ends[article][1] and 2 * size(i) > size(article):
            article = i
    within = {i for i in bodies if article < i < ends[article][1] and 2 * size(i) > size(article)}
    return within | {i for i in named if i <= article < ends[i][1]}


def scored(page: str, weights: Weights = WEIGHTS) -> tuple[list[str | None], list[float]]:
    """The page as a sequence of pieces and their scores: text (empty for a tag), and None where a block ends.

    Text scores by its words, tags take something off. Comments, scripts and the text of other parts are left out;
    an element around the article is no other part.
    """
    pieces: list[str | None] = []
    scores: list[float] = []
    found = events(page)
    around = wrappers(found, weights)
    # Open elements: (whether another part, whether an article, the largest bonus so far of its words).
    stack: list[tuple[bool, bool, float]] = []
    others = articles = number = 0
    for text, piece, ended, opens in found:
        if text is not None:
            if not others:
                text = html.unescape(text)
                pieces.append(text)
                scores.append(len(text.split()) * (weights.word + (stack[-1][2] if stack else 0.0)))
            continue
        closed = 0.0
        if ended:
            before = articles
            others -= sum(other for other, _, _ in stack[-ended:])
            articles -= sum(article for _, article, _ in stack[-ended:])
            del stack[-ended:]
            closed = weights.wall if before and not articles else 0.0
        name, keys, unseen, stays, attributes = opens
        pieces.append(piece)
        if not name:
            scores.append(closed)
            continue
        known = inner_signatures(name, attributes) if articles else keys
        other = name not in VOID and (unseen or (not (stays and number in around) and weights.is_other(known, articles > 0)))
        article = not other and weights.is_article(keys)
        enters = not articles and (article or (other and not others))
        scores.append(closed + (weights.wall if enters else weights.tag))
        if stays:
            stack.append((other, article, max(weights.bonus(keys), stack[-1][2] if stack else 0.0)))
            others += other
            articles += article
            number += 1
    return pieces, scores


def best_run(scores: list[float]) -> tuple[int, int]:
    """The bounds of the run with the largest sum, the first of equal ones; (0, 0) if no score is positive."""
    best, bounds, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, bounds = total, (start, i + 1)
    return bounds


def main_text(page: str | None, weights: Weights = WEIGHTS) -> str:
    """The text of the page's article, one block a line."""
    pieces, scores = scored(page or "", weights)
    start, end = best_run(scores)
    blocks, block = [], []
    for piece in [*pieces[start:end], None]:
        if piece is not None:
            block.append(piece)
        elif block:
            blocks.append(" ".join("".join(block).split()))
            block = []
    return "\n".join(filter(None, blocks))


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(<id_col>, <url_col>, text, n_chars)`` of each page: its main text and the number of its code points.

    The page becomes a sequence of words and tags. Words score more the likelier their surrounding elements belong to
    an article, tags take something off, and the boundary of an article or of another part (menu, header, footer,
    sidebar, notice, advert, form, reader comments) takes much; the run with the largest sum is the article. Other
    parts within it are left out; an element that stands around the article is none, whatever its name. Character references are decoded, white space in a block becomes one space, blocks
    are joined by one line end. Null and empty pages, and those without words, give an empty text; null ids and urls
    stay null; repeated pages are extracted each. Pages are read whole, one after the other.
    """

    def run(batches):
        for batch in slices(batches, "html"):
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [id_col, url_col, "text", "n_chars"],
            )

    rows = pick(df, id=(id_col, "long"), url=(url_col, "string"), html=(html_col, "string"))
    return rows.mapInArrow(run, f"`{id_col}` long, `{url_col}` string, text string, n_chars long")
