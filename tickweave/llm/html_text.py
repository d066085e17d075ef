"""Main text of a web page as the contiguous region with the largest sum of token scores.

A page is read as a row of tokens. Runs of text score their words times a weight of where they stand,
tags score negative; one linear scan finds the best contiguous region. The weights are log-odds counted
on labelled pages (labelled_pages: layouts whose content is marked). Inside the region, text that stands
in an element of its own for menus, adverts, notices, forms, comments and the like is left out, and so is
what browsers don't show as text (scripts, styles, drawings, embedded media and their fallbacks).

Null and empty pages give an empty text. Pages are read once from front to back, however long or broken:
a tag whose quotes don't close ends at its first >, and what can't be a tag is text. Every page is worked
on whole and by itself, and every input row gives one row, repeated rows too, an empty table none. Of
equally good regions the first counts. Only page_id, url and html are read, so other columns clash with
nothing.
"""

from __future__ import annotations

import html as html_entities
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

#: Elements by what HTML says of them.
RAW = frozenset("script style title textarea noscript template iframe svg object canvas audio video select".split())
#: Of these, those in the head or without a place in the text.
UNSEEN = frozenset("script style title template noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr"
    " math mi mn mo ms mspace mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd mstyle mpadded mphantom semantics annotation").split())  # fmt: skip
#: Elements that a slash before the end of their tag closes: those of formulas, not those of HTML.
FOREIGN = frozenset("math mi mn mo ms mspace mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd mstyle mpadded mphantom semantics annotation".split())
MAIN = frozenset(("article", "main"))
ASIDE = frozenset("nav footer aside form button dialog menu fieldset".split())
SELF_CLOSING = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "option": ("option",)}
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Words of class, id and role that name what isn't the article, and what is.
NOT_MAIN = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login|search"
    r"|side-?bar|widget|nav\w*|menu|breadcrumbs?|pagination|pager|toolbar|toc|footer|copyright|masthead|topbar|skip"
    r"|comments?|comment-?list|disqus|replies|respond|reactions|share|sharing|social|follow|related|recommended|recirc|more-?stories|trending|popular|tags|complementary|contentinfo|navigation|hidden)(?:$|[\s_-])",
    re.I,
)
IS_MAIN = re.compile(r"(?:^|[\s_-])(?:main|article|article-?body|post-?body|post-?content|entry-?content|story|story-?body|main-?content|post|entry|content)(?:$|[\s_-])", re.I)

#: Words that stand beside those in names of such elements. Inside a marked article a name counts only if it is made of both.
_BESIDE = re.compile(
    r"(?:\d+|ads?|site|page|global|main|top|bottom|left|right|inner|outer|inline|sticky|fixed|float\w*|mobile|desktop|primary|secondary|sub|new|user|reader|post|article|story|content|entry"
    r"|box|container|wrapper|wrap|block|section|area|zone|slot|unit|bar|panel|row|column|group|list|items?|links?|buttons?|btn|icons?|tools?|form|header|title|text|body|content|posts?|articles?|stories|news|count|thread|area|module|component|cta|us|me|it|this|in|up)"
    r"|(?:advert|sponsor|nav|float)\w*",
    re.I,
)
#: Elements that a name can set aside inside a marked article.
_NAMED = frozenset("div section ul ol dl span p a table header footer".split())

#: Names that say what a page has or lacks, not what an element is.
_LAYOUT = re.compile(r"(?:^|[_-])(?:no|not|has|with|without|hide|show|enabled?|disabled?|layout|theme|template)(?:[_-]|$)", re.I)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s]++)))?")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
_UP_TO_QUOTE = re.compile(r"[^>\"']*+")


def _sets_aside(name: str, names: str, in_main: bool) -> bool:
    """Whether an element's names say that it isn't part of the article."""
    if not in_main:
        return bool(NOT_MAIN.search(names))
    if name not in _NAMED:
        return False
    for token in names.split():
        words = [w for w in re.split("[_-]+", token) if w]
        if NOT_MAIN.search(token) and all(NOT_MAIN.search(w) or _BESIDE.fullmatch(w) or NOT_MAIN.fullmatch(token) for w in words):
            return True
    return False


class _Reader:
    """Finds the ends of tags; never reads a part of the page more than twice."""

    def __init__(self, page: str):
        self.page = page
        #: Before this place quotes have been found open, so tags end at their first >.
        self.broken = 0

    def end(self, at: int) -> int:
        """Where the > of the tag at this place is; -1 if there is none."""
        page, i = self.page, at
        while i >= self.broken:
            i = _UP_TO_QUOTE.match(page, i).end()
            if i == len(page):
                break
            if page[i] == ">":
                return i
            close = page.find(page[i], i + 1)
            if close < 0:
                break
            i = close + 1
        self.broken = max(self.broken, i)
        return page.find(">", at)


def _markup(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, kind, name, attributes) of what isn't text, in order; kind is skip, raw, open or close."""
    reader, at = _Reader(page), 0
    ends_of_raw: dict[str, re.Pattern] = {}
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            yield at, (at := end + 3 if end >= 0 else len(page)), "skip", "", ""
            continue
        closing = page.startswith("</", at)
        name = _NAME.match(page, at + 1 + closing)
        if not name and not page.startswith(("<!", "<?", "</"), at):
            at += 1
            continue
        end = page.find(">", at) if not name else reader.end(name.end())
        if end < 0:
            return  # no tag ends from here on
        start, at = at, end + 1
        if not name:
            yield start, at, "skip", "", ""
            continue
        what, attributes = name[0].lower(), page[name.end() : end]
        if what in RAW and not closing:
            if not (attributes.endswith("/") and what == "svg"):
                found = ends_of_raw.setdefault(what, re.compile(f"</{what}\\s*>", re.I)).search(page, at)
                at = found.end() if found else len(page)
            yield start, at, "raw", what, ""
        else:
            yield start, at, "close" if closing else "open", what, attributes


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}


def tokens(page: str, by_name: bool = True) -> Iterator[tuple[str, str, str]]:
    """(kind, what, text): ("text", place, raw text), ("tag", group, "block" or "") in page order.

    The place of text is main, aside, link or plain, or within if it is set aside inside main; a tag's
    group is within if it stands inside main, else main (the bounds of main), aside, block or inline.
    by_name: whether class, id and role can set an element aside. A main element does away with what the
    names of the elements around it say.
    """
    stack: list[tuple[str, str]] = []
    held: dict[str, list[int]] = {}  # places of the open elements of each name
    walls: list[int] = []  # places of those that are main or set aside
    named: list[int] = []
    main = aside = link = 0
    at = 0

    def place() -> str:
        if aside:
            return "within" if main else "aside"
        return "main" if main else "link" if link else "plain"

    def leave(i: int) -> None:
        nonlocal main, aside, link
        for name, kind in stack[i:]:
            held[name].pop()
            main -= kind == "main"
            aside -= kind in ("aside", "named")
            link -= kind == "link"
        del stack[i:]
        for places in (walls, named):
            while places and places[-1] >= i:
                places.pop()

    def wall() -> int:
        """The innermost main element or one that is set aside; -1 if there is none."""
        while walls and stack[walls[-1]][1] == "":  # its name no longer counts
            walls.pop()
        return walls[-1] if walls else -1

    for start, end, what, name, text in _markup(page):
        if start > at:
            yield "text", place(), page[at:start]
        at = end
        if what in ("skip", "raw"):
            if what == "raw" and name not in UNSEEN:
                yield "tag", "within" if main else "block", "block"
            continue
        flow = "" if name in INLINE else "block"
        if what == "close":
            i = held[name][-1] if held.get(name) else None
            if i is not None and (name in INLINE or name == "p") and i < wall():
                i = None
            was = main
            if i is not None:
                leave(i)
            yield "tag", "within" if main else "main" if was else "aside" if name in ASIDE else "block" if flow else "inline", flow
            continue
        for old in (*SELF_CLOSING.get(name, ()), *(("p",) if name in CLOSES_P else ())):
            if stack and stack[-1][0] == old:
                leave(len(stack) - 1)
        own = _attributes(text) if text.strip(" /") else {}
        names = " ".join(n for k in ("class", "id", "role") for n in own.get(k, "").split() if not _LAYOUT.search(n))
        hidden = "hidden" in own and own["hidden"].lower() != "until-found" or own.get("aria-hidden", "").lower() == "true" or _NOT_SHOWN.search(own.get("style", ""))
        if name in ASIDE or name == "header" and not main or hidden:
            kind = "aside"
        elif name == "main":
            kind = "main"
            # elements around it were named for something else
            for i in named:
                stack[i] = stack[i][0], ""
            aside -= len(named)
            named.clear()
        elif by_name and names and name not in ("body", "html") and _sets_aside(name, names, bool(main)):
            kind = "named"
        elif name in MAIN or names and name in ("div", "section", "td") and IS_MAIN.search(names):
            kind = "main"
        elif name == "a":
            kind = "link"
        else:
            kind = ""
        was = main
        if name not in VOID and not (name in FOREIGN and text.endswith("/")):
            held.setdefault(name, []).append(len(stack))
            if kind in ("main", "aside", "named"):
                walls.append(len(stack))
            if kind == "named":
                named.append(len(stack))
            stack.append((name, kind))
            main += kind == "main"
            aside += kind in ("aside", "named")
            link += kind == "link"
        yield "tag", "within" if was else "main" if main else "aside" if kind in ("aside", "named") else "block" if flow else "inline", flow
    if at < len(page):
        yield "text", place(), page[at:]


_MARK = "\x02"


def labelled_pages() -> Iterator[str]:
    """Layouts of pages; text that holds the mark is content. Every layout is met with several amounts of text."""
    text = lambda n: f"{_MARK} " + "word " * n
    other = lambda n: "word " * n
    menus = ("<nav><ul>{}</ul></nav>", "<div class='menu'><ul>{}</ul></div>", "<ul>{}</ul>", "<header><h2>word</h2><ul>{}</ul></header>")
    bodies = ("<article><h1>{}</h1>{}</article>", "<main><h1>{}</h1>{}</main>", "<div class='post-content'><h1>{}</h1>{}</div>", "<div><h1>{}</h1>{}</div>", "<h1>{}</h1>{}")
    middles = ("", "<div class='ad'>{}</div>", "<aside><p>{}</p></aside>", "<form><p>{}</p></form>")
    ends = ("<footer><p>{}</p></footer>", "<div id='comments'><p>{}</p></div><footer>{}</footer>", "<div><a href='/'>{}</a></div>", "<section class='related'><ul><li><a href='/'>{}</a></li></ul></section>")
    for n, (menu, body, middle, end) in enumerate(itertools.product(menus, bodies, middles, ends)):
        items = "".join(f"<li><a href='/{i}'>{other(1 + i % 2)}</a></li>" for i in range(3 + n % 5))
        inner = ("<b>{}</b>", "<a href='/x'>{}</a>", "<em>{}</em><br>")
        paragraphs = [f"<p>{text(8 + (n * 7 + i * 5) % 40)}{inner[(n + i) % 3].format(text(2))} {text(6)}</p>" for i in range(2 + n % 4)]
        paragraphs.insert(1, middle.replace("{}", other(6)))
        yield f"<html><body>{menu.format(items)}{body.format(text(4), ''.join(paragraphs))}{end.replace('{}', other(7))}</body></html>"


@cache
def weights() -> dict[tuple[str, str], float]:
    """Log-odds of content by place of text, per word, and by group of tag, within bounds; tags score below zero.

    Text set aside inside main weighs nothing: it is left out either way, and must not part what is around it.
    """
    inside, outside = Counter(), Counter()
    for page in labelled_pages():
        row = list(tokens(page))
        marked = [i for i, (_, _, t) in enumerate(row) if _MARK in t]
        for i, (kind, what, t) in enumerate(row):
            n = len(t.replace(_MARK, "").split()) if kind == "text" else 1
            content = marked[0] <= i <= marked[-1]
            (inside if content else outside)[kind, what] += n
    total_in, total_out = sum(inside.values()), sum(outside.values())
    out = {}
    for key in inside.keys() | outside.keys():
        odds = math.log((inside[key] + 1) / (total_in + 1)) - math.log((outside[key] + 1) / (total_out + 1))
        low, top = (-0.8, -0.05) if key[0] == "tag" else (-2.0, 0.0 if key[1] in ("aside", "within") else 3.0)
        out[key] = max(low, min(odds, top))
    out["text", "within"] = 0.0
    return out


def best_region(gains: list[float]) -> tuple[int, int]:
    """First and last place of the contiguous run with the largest sum above zero, the first of equals; (0, -1) if none."""
    best, first, last, total, start = 0.0, 0, -1, 0.0, 0
    for i, gain in enumerate(gains):
        if total <= 0:
            total, start = 0.0, i
        total += gain
        if total > best:
            best, first, last = total, start, i
    return first, last


def main_text(page: str | None) -> str:
    """The text of the best region, its blocks joined by newlines.

    If a page has none, it is read again as if names set nothing aside.
    """
    return (_text(list(tokens(page))) or _text(list(tokens(page, by_name=False)))) if page else ""


def _text(row: list[tuple[str, str, str]]) -> str:
    score = weights()
    has_main = any(kind == "text" and what == "main" and t.strip() for kind, what, t in row)
    gains = []
    for kind, what, t in row:
        if kind == "text":
            place = "link" if has_main and what == "plain" else what  # beside a marked article, loose text is none
            gains.append(len(t.split()) * score.get((kind, place), 0.0))
        else:
            gains.append(score.get((kind, what), -0.05))
    first, last = best_region(gains)
    blocks, parts = [], []
    for kind, what, t in row[first : last + 1]:
        if kind == "text":
            if what not in ("aside", "within"):
                parts.append(html_entities.unescape(t) if "&" in t else t)
        elif t and parts:
            blocks.append(" ".join("".join(parts).split()))
            parts = []
    blocks.append(" ".join("".join(parts).split()))
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, 64):
                texts = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kept = pages.select("page_id", "url", "html")
    kind = kept.schema["page_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op2_html_main_text(spark, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages"))
