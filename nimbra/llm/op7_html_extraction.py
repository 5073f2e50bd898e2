"""Main text of web pages by tree scoring.

A page becomes a tree of elements and a list of text blocks. Menus, forms, adverts and
the like go by element, role and class, unless they hold the article itself. Each
block passes points for its length and commas to its ancestors, less the further up;
an element's points are discounted by the share of its text that is links. The best
element, widened to the article or main element around it, is kept with those of its
siblings that score well or read as text. Inside it, a list of links goes where its class,
role or heading says that it leads elsewhere; a list of references stays.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from nimbra.llm.common import table

# --- values of the method, after the published readability heuristics ---
LEAST_PARAGRAPH = 25
CHARS_PER_POINT = 100
MOST_LENGTH_POINTS = 3
LEVELS = 5
SIBLING_SHARE = 0.2
SIBLING_POINTS = 10
LINKED_LIST_DENSITY = 0.5
SIBLING_TEXT = 80
MOST_ANNOUNCING = 60
SIBLING_DENSITY = 0.25

#: Elements whose content is not read. Without an end tag the first ones reach to the end of
#: the page, as their content is no markup; the others are passed over then.
PLAIN = frozenset(["script", "style", "textarea", "title"])
RAW = PLAIN | frozenset(["noscript", "template", "iframe", "svg", "select"])
VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: Start tags that end an open element of the same group, up to one of the limits.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
NEVER = frozenset(["nav", "footer", "aside", "head", "button", "menu", "dialog"])
DOUBTFUL = frozenset(["form", "header", "fieldset"])
CONTENT = frozenset(["article", "main"])
UNWANTED = re.compile(
    r"ads?|advert\w*|adslot|adbox|adsense|banner|sponsor\w*|promo\w*|cookies?\w*|consent|gdpr|notices?|notification\w*|"
    r"popup|modal|overlay|newsletter|subscri\w*|comments?|commentlist|disqus|respond|repl(?:y|ies)|sidebar\w*|sidenav|"
    r"related|recommend\w*|shar(?:e|es|ing)|social|menu|nav|navbar|navigation|breadcrumbs?|footer|foot|masthead|topbar|"
    r"toolbar|login|signup|widgets?|pagination|pager|complementary|contentinfo|search|alert|dialog|outbrain|taboola|teasers?"
)
#: Headings of link lists that are no part of the article, in en, de, fr and es.
RELATED = re.compile(
    r"(?:related|read (?:more|next|also)|more (?:from|on|stories|articles|like)|see also|you (?:may|might) also|most read|popular|trending|"
    r"recommended|latest|mehr zum|mehr (?:aus|von)|lesen sie auch|auch interessant|das könnte|meistgelesen|verwandte|"
    r"à lire|lire aussi|voir aussi|articles? (?:liés|similaires)|sur le même|les plus lus|relacionad\w*|artículos relacionados|"
    r"más (?:noticias|leíd\w*|sobre)|leer? (?:más|también)|te puede interesar|lo más)\b",
    re.I,
)
#: How a sentence ends: what stands so in an article's own header is its standfirst.
SENTENCE_END = re.compile(r"[.!?…。！？][\"'”’»)]*\Z")
OWN_HEADER = frozenset(["article", "entry", "post", "content", "story"])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_WORDS = re.compile(r"[a-zA-Z0-9]+")


class Page:
    """Elements (parallel lists; parents come before children) and blocks of a page."""

    def __init__(self, source: str):
        self.tag, self.parent, self.attributes = ["#root"], [0], [""]
        self.block_of = [0]  # the nearest block element, itself included
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self._parse(source)

    def _parse(self, source: str) -> None:
        stack, parts, at, linked, links = [0], [], 0, 0, 0
        opened: Counter[str] = Counter()  # elements of each name in the stack

        def flush() -> None:
            nonlocal parts, linked
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    # an inline element may still be open: the block is its nearest block element's
                    self.blocks.append((self.block_of[stack[-1]], text, min(linked, len(text))))
            parts, linked = [], 0

        def pop(to: int) -> None:
            nonlocal links
            while len(stack) > to:
                name = self.tag[stack.pop()]
                opened[name] -= 1
                if name == "a":
                    links -= 1

        def text(until: int) -> None:
            nonlocal linked
            if until > at:
                piece = source[at:until]
                if "&" in piece:
                    piece = entities.unescape(piece)
                parts.append(piece)
                if links:
                    linked += len(" ".join(piece.split()))

        while True:
            found = _TOKEN.search(source, at)
            if found is None:
                text(len(source))
                break
            text(found.start())
            at = found.end()
            if found[2] is None:
                continue
            name = found[2].lower()
            if found[1]:
                if name == "br" or name == "p" and not opened["p"]:
                    parts.append(" ")
                    continue
                place = None
                if opened[name]:
                    place = next(i for i in range(len(stack) - 1, 0, -1) if self.tag[stack[i]] == name)
                if name in BLOCKS:
                    flush()
                if place is not None and not (
                    name not in BLOCKS and any(self.tag[n] in BLOCKS for n in stack[place + 1 :])
                ):
                    pop(place)
                elif place is not None:  # an inline end inside a later block: that element ends alone
                    if name == "a":
                        links -= 1
                    opened[name] -= 1
                    del stack[place]
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                if end and not found[3].rstrip().endswith("/"):
                    at = end.end()
                elif name in PLAIN:
                    at = len(source)
                parts.append(" ")
                continue
            if name in VOID:
                if name == "hr":
                    flush()
                elif name == "br":
                    parts.append(" ")
                continue
            if name in BLOCKS:
                flush()
                if opened["p"]:  # a block ends an open paragraph, and what it held
                    pop(next(i for i in range(len(stack) - 1, 0, -1) if self.tag[stack[i]] == "p"))
                group, limits = ENDS.get(name, (frozenset(), frozenset()))
                for i in range(len(stack) - 1, 0, -1):
                    if not any(opened[other] for other in group) or self.tag[stack[i]] in limits:
                        break
                    if self.tag[stack[i]] in group:
                        pop(i)
            if name == "a":
                links += 1
            self.tag.append(name)
            self.parent.append(stack[-1])
            self.attributes.append(found[3])
            self.block_of.append(len(self.tag) - 1 if name in BLOCKS else self.block_of[stack[-1]])
            if not (found[3].endswith("/") and name not in BLOCKS):
                stack.append(len(self.tag) - 1)
                opened[name] += 1
            elif name == "a":
                links -= 1
        flush()


def _names(attributes: str) -> set[str]:
    out: set[str] = set()
    for value in _NAMES.findall(attributes):
        value = value.strip("\"'")
        out.update(word.lower() for word in _WORDS.findall(_CAMEL.sub(" ", value)))
        out.update(word.lower() for word in _WORDS.findall(value))
    return out


def _points(text: str) -> float:
    if len(text) < LEAST_PARAGRAPH:
        return 0.0
    return 1 + text.count(",") + text.count("、") + text.count("，") + min(len(text) / CHARS_PER_POINT, MOST_LENGTH_POINTS)


def main_text(source: str) -> str:
    """The main text: its blocks in page order, joined by an empty line; empty if there is none."""
    page = Page(source)
    if not page.blocks:
        return ""
    tag, parent = page.tag, page.parent
    n = len(tag)
    points = [_points(text) for _, text, _ in page.blocks]

    # what every element holds: points, an article inside, characters, characters in links, links
    held, article, chars, linked, anchors = [0.0] * n, [False] * n, [0] * n, [0] * n, [0] * n
    for (owner, text, in_links), got in zip(page.blocks, points, strict=True):
        held[owner] += got
        chars[owner] += len(text)
        linked[owner] += in_links
    for i in range(n - 1, 0, -1):
        p = parent[i]
        held[p] += held[i]
        chars[p] += chars[i]
        linked[p] += linked[i]
        anchors[p] += anchors[i] + (tag[i] == "a")
        article[p] = article[p] or article[i] or tag[i] in CONTENT
    inside, gone, titles = [False] * n, [False] * n, [False] * n
    for i in range(1, n):
        p, name = parent[i], tag[i]
        inside[i] = inside[p] or name in CONTENT
        titles[i] = titles[p]
        gone[i] = gone[p]
        if gone[i]:
            continue
        attributes = page.attributes[i]
        names = _names(attributes) if attributes else ()
        unwanted = any(UNWANTED.fullmatch(word) for word in names)
        header = name == "header" or "header" in names
        most = article[i] or 2 * held[i] > held[0] or name in ("html", "body", "main")
        if name in NEVER or attributes and _HIDDEN.search(attributes):
            gone[i] = not article[i]
        elif name in HEADINGS or name in ("p", "span", "b", "em", "strong", "i", "a"):
            gone[i] = unwanted and name not in HEADINGS
        elif header and not most:
            if inside[p] or OWN_HEADER.intersection(names):
                titles[i] = True  # an article's own header: its headings are text
            else:
                gone[i] = True
        elif unwanted or name in DOUBTFUL:
            gone[i] = not most or (name == "article" and unwanted and not 2 * held[i] > held[0])
    if all(gone[owner] for owner, _, _ in page.blocks):
        return ""

    score: dict[int, float] = {}
    for (owner, _, _), got in zip(page.blocks, points, strict=True):
        if got and not gone[owner]:
            up = owner if tag[owner] not in ("p", "pre", "td", "li", "blockquote") and tag[owner] not in HEADINGS else parent[owner]
            for level in range(LEVELS):
                score[up] = score.get(up, 0.0) + got / (1 if level == 0 else 2 if level == 1 else 3 * level)
                if up == 0:
                    break
                up = parent[up]
    density = lambda i: linked[i] / chars[i] if chars[i] else 0.0
    rated = {i: got * (1 - density(i)) for i, got in score.items()}
    if rated:
        best = max(rated, key=lambda i: (rated[i], -i))
    else:
        best = next((i for i in range(n) if tag[i] in CONTENT and not gone[i] and chars[i]), 0)
    top, up = rated.get(best, 0.0), best
    while up:  # the article or main element around it, if there is one
        if tag[up] == "article" or tag[up] == "main" and not any(tag[j] == "article" and not gone[j] for j in _path(parent, best)):
            best = up
            break
        up = parent[up]

    announced = _announced(page)
    related = {i for followers in announced.values() for i in followers}
    keep = [False] * n
    keep[best] = True
    if best:
        for i in range(1, n):
            if parent[i] == parent[best] and i != best and not gone[i] and chars[i] and tag[best] not in CONTENT:
                keep[i] = (
                    rated.get(i, 0.0) >= max(SIBLING_POINTS, SIBLING_SHARE * top)
                    or tag[i] in HEADINGS
                    or (tag[i] in ("p", "pre", "blockquote") and (density(i) < SIBLING_DENSITY if chars[i] > SIBLING_TEXT else not linked[i]))
                )
            elif parent[i] == parent[best] and i != best and tag[i] == "article" and not gone[i]:
                keep[i] = rated.get(i, 0.0) >= max(SIBLING_POINTS, SIBLING_SHARE * top)
    for i in range(1, n):
        if gone[i]:
            keep[i] = False
        elif keep[parent[i]]:
            linked_list = tag[i] in ("ul", "ol", "div", "section", "table", "dl") and anchors[i] > 1 and density(i) > LINKED_LIST_DENSITY
            keep[i] = not (linked_list and i in related)
    for heading, followers in announced.items():  # a heading goes with what it announced
        if any(not keep[i] for i in followers) and not any(keep[i] and chars[i] for i in followers):
            keep[heading] = False

    def stands(owner: int, text: str, in_links: int) -> bool:
        """Of an article's own header, its headings and standfirst are text, and bylines are not."""
        if not titles[owner] or tag[owner] in HEADINGS:
            return True
        return len(text) >= LEAST_PARAGRAPH and not in_links and SENTENCE_END.search(text) is not None

    return "\n\n".join(text for owner, text, in_links in page.blocks if keep[owner] and stands(owner, text, in_links))


def _announced(page: Page) -> dict[int, list[int]]:
    """By heading (or short line) that announces other articles: the elements after it at its own
    level, up to the next heading; if there is none before, its parent too."""
    out: dict[int, list[int]] = {}
    by_parent: dict[int, list[int]] = {}
    for i in range(1, len(page.tag)):
        by_parent.setdefault(page.parent[i], []).append(i)
    for owner, text, _ in page.blocks:
        if owner and len(text) <= MOST_ANNOUNCING and RELATED.match(text):
            siblings = by_parent[page.parent[owner]]
            at = siblings.index(owner)
            followers = []
            for other in siblings[at + 1 :]:
                if page.tag[other] in HEADINGS:
                    break
                followers.append(other)
            out[owner] = followers + [page.parent[owner]] * (at == 0)
    return out


def _path(parent: list[int], i: int) -> Iterator[int]:
    while i:
        yield i
        i = parent[i]


@F.pandas_udf(StringType())
def _main_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pd.Series([main_text(page or "") for page in pages], dtype=object)


def main_texts(source: Column) -> Column:
    return _main_texts(source)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Adds ``text`` and ``n_chars`` (code points) to every row of ``pages`` (a column ``text``
    of its own is replaced). Null, empty and text-free pages give an empty text. No shuffle."""
    found = pages.withColumn("text", main_texts(F.col(html_col)))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
