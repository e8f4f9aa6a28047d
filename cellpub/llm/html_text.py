"""Main text of HTML pages from flat text blocks.

A page is read once into flat blocks: runs of text between block-level tags, each with its number of words, its link density,
the same of the blocks before and after, whether it ends as a sentence does, and what its open elements say about its place (headline, inside an article, inside
navigation, footers, asides, forms of controls, or elements whose class or id is the name of an advert, a notice, comments and the like).
A decision tree, trained on the small labelled table below, tells content from the rest. Scripts, styles and comments never become blocks.

Names count as whole ones only, made of known parts. Inside an article or main element only unmistakable ones count, and never the id of a heading or section, which is
made from its title. A form is outside the text if it has more controls than text, as pages may be wrapped in one.

Defined cases: null html counts as empty and has empty text; unclosed tags end with their parents or the page, an unclosed head where the body begins; a tag
without its ``>`` is text, and quotes that never end do not count; repeated rows give
equal rows; long pages are read whole, in time linear in their length; other columns than the named ones are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of HTML: tags that end a block, elements whose content is no text, elements without content.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html legend li main menu nav noscript ol option p pre section select summary table tbody td template tfoot th thead title tr ul".split()
)
SILENT = frozenset("script style noscript template title head iframe object svg math canvas audio video select textarea button datalist".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end an open <p>, as HTML says.
ENDS_P = BLOCK_TAGS - frozenset("body head html option caption dd dt li td th tr tbody thead tfoot legend summary title".split())
#: Elements that an end tag of something inside doesn't get past, and elements that are not text of the article by themselves.
SCOPE = frozenset("article aside body div footer form header html main nav section table ul ol dl td".split())
OUTSIDE = frozenset("nav footer aside menu dialog".split())
CONTROLS = frozenset("input select textarea button".split())
#: What a name may begin and end with, and the terms that name adverts, notices, menus, comments and the like: those that are unmistakable in an article, and the others.
BEFORE = "site page main global top bottom left right footer header sidebar post entry article blog primary secondary mobile desktop sticky fixed js wp l c u the social cookie email user inline".split()
AFTER = (
    "bar box wrap wrapper container area section list lists item items link links menu block inner main top bottom left right banner notice consent popup overlay form widget widgets slot unit nav "
    "buttons button icons thread wrapperouter text title message signup policy-notice posts articles stories cloud to primary secondary".split()
)
TERMS = (
    "ads? adverts? advertisements? adsense adsbygoogle sponsor sponsored promos? comments? commentlist commentarea commentform disqus respond cookies? cookiebar cookiebanner cookienotice cookieconsent "
    "newsletters? subscribe subscription share sharing sharebar sharebuttons? social breadcrumbs? pagination pager side-?bars? footers? skip skiplinks? skipnav tag-?(?:cloud|list|links) nav-?links nav-?bar "
    "related-?(?:posts|articles|links|stories) gdpr".split()
)
OTHERS = (
    "advertis(?:ing) banners? promotions? navs? navigation navmenu menus? menubar aside related consent notices? popup modal signup login replies reply tags copyright legal alerts? toolbar masthead".split()
)


def _names(terms: list[str]) -> re.Pattern:
    return re.compile(f"(?:(?:{'|'.join(BEFORE)})[-_]+)*(?:{'|'.join(terms)})(?:[-_]+(?:{'|'.join(AFTER)}))*[-_]*[0-9]*")


UNMISTAKABLE, NAMES = _names(TERMS), _names(TERMS + OTHERS)
HEADERS = re.compile(r"(?:(?:site|main|global|top|page)[-_]?)?header(?:[-_](?:bar|top|nav|menu|inner|wrap|wrapper|container))?")
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
#: Elements that may be in a head; any other begins the body.
HEAD_TAGS = frozenset("head base basefont bgsound link meta title style script noscript template".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
TAG_STOP, VALUE, VALUE_END = re.compile(r"[>=]"), re.compile(r"\s*"), re.compile(r"[\s>]")
#: A whole name with its value, so nothing inside a value or a longer name counts as a name. Quotes count only where a value begins.
ATTRIBUTE = re.compile(r"([^\s>/=][^\s>/=]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
SPACES = re.compile(r"\s+")
#: How a sentence ends, with closing signs.
SENTENCE = re.compile(r"[.!?…。:;][\"'”’»)\]]*$")
#: Words of a form for each of its controls beyond which it is text.
WORDS_A_CONTROL = 20

FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after", "outside", "inside", "heading", "link_list", "sentence")

#: Words and link density before and after a block, also at the beginning and the end of a page.
LENGTHS = (1, 9, 10)
NEAR = [(b, x, a, y) for b in LENGTHS for x in (0.00, 1.00) for a in LENGTHS for y in (0.00, 1.00)]
ENDS = [(0, 0.00, a, y) for a in LENGTHS for y in (0.00, 1.00)] + [(b, x, 0, 0.00) for b in LENGTHS for x in (0.00, 1.00)] + [(0, 0.00, 0, 0.00)]
#: The labelled table: blocks of ten hand-made pages (news, blog, shop, forum, docs; with and without article elements),
#: and blocks between all kinds of neighbours (menus, related links, link-only paragraphs).
#: words, link density, words and link density before and after, outside, inside, heading, list item of links, sentence -> content
LABELLED = [
    (1, 1.00, 0, 0.00, 1, 1.00, 1, 0, 0, 1, 0, 0), (1, 1.00, 1, 1.00, 1, 1.00, 1, 0, 0, 1, 0, 0), (2, 1.00, 1, 1.00, 9, 0.00, 1, 0, 0, 1, 0, 0),
    (1, 1.00, 1, 1.00, 12, 0.00, 0, 0, 0, 1, 0, 0), (2, 1.00, 3, 1.00, 2, 1.00, 0, 0, 0, 1, 0, 0), (4, 1.00, 2, 1.00, 30, 0.00, 0, 0, 0, 1, 0, 0),
    (9, 0.00, 1, 1.00, 8, 0.00, 1, 0, 0, 0, 1, 0), (22, 0.05, 1, 1.00, 8, 0.00, 1, 0, 0, 0, 1, 0), (45, 0.00, 6, 1.00, 10, 0.00, 1, 0, 0, 0, 1, 0),
    (8, 0.00, 9, 0.00, 60, 0.00, 0, 1, 1, 0, 0, 1), (11, 0.00, 2, 1.00, 45, 0.00, 0, 1, 1, 0, 0, 1), (3, 0.00, 80, 0.00, 70, 0.02, 0, 1, 1, 0, 0, 1),
    (60, 0.00, 8, 0.00, 35, 0.00, 0, 1, 0, 0, 1, 1), (35, 0.03, 60, 0.00, 90, 0.00, 0, 1, 0, 0, 1, 1), (90, 0.00, 35, 0.00, 6, 0.00, 0, 1, 0, 0, 1, 1),
    (6, 0.00, 90, 0.00, 40, 0.00, 0, 1, 0, 0, 1, 1), (1, 0.00, 40, 0.00, 50, 0.00, 0, 1, 0, 0, 0, 1), (2, 0.00, 50, 0.00, 14, 0.00, 0, 1, 0, 0, 0, 1),
    (14, 0.20, 2, 0.00, 9, 0.00, 0, 1, 0, 0, 1, 1), (5, 0.00, 14, 0.20, 12, 0.10, 0, 1, 0, 0, 0, 1), (7, 0.60, 55, 0.00, 20, 0.00, 0, 1, 0, 0, 0, 1),
    (3, 1.00, 70, 0.00, 65, 0.00, 0, 1, 0, 0, 0, 1), (12, 0.10, 6, 0.00, 0, 0.00, 1, 0, 0, 0, 1, 0), (16, 0.00, 90, 0.00, 0, 0.00, 1, 0, 0, 0, 1, 0),
    (10, 0.00, 75, 0.00, 30, 0.00, 1, 1, 0, 0, 1, 0), (30, 0.00, 10, 0.00, 28, 0.00, 1, 1, 0, 0, 1, 0), (28, 0.00, 30, 0.00, 2, 1.00, 1, 1, 0, 0, 1, 0),
    (2, 0.00, 28, 0.00, 40, 0.00, 1, 1, 1, 0, 0, 0), (40, 0.05, 2, 0.00, 5, 0.00, 1, 1, 0, 0, 1, 0), (5, 1.00, 40, 0.05, 5, 1.00, 1, 1, 0, 1, 0, 0),
    (6, 0.00, 3, 1.00, 55, 0.00, 0, 0, 1, 0, 0, 1), (55, 0.00, 6, 0.00, 70, 0.04, 0, 0, 0, 0, 1, 1), (70, 0.04, 55, 0.00, 25, 0.00, 0, 0, 0, 0, 1, 1),
    (25, 0.00, 70, 0.04, 8, 0.00, 0, 0, 0, 0, 1, 1), (9, 0.00, 40, 0.00, 62, 0.00, 0, 0, 0, 0, 1, 1), (18, 0.10, 33, 0.00, 20, 0.00, 0, 0, 0, 0, 1, 1),
    (5, 0.00, 2, 1.00, 2, 1.00, 0, 0, 0, 0, 0, 0), (4, 0.50, 1, 1.00, 3, 1.00, 0, 0, 0, 0, 0, 0), (7, 0.00, 25, 0.00, 0, 0.00, 1, 0, 0, 0, 1, 0),
    (3, 1.00, 4, 1.00, 3, 1.00, 1, 1, 0, 1, 0, 0), (12, 0.90, 6, 1.00, 4, 1.00, 0, 0, 0, 0, 0, 0), (8, 0.80, 70, 0.00, 9, 0.90, 0, 0, 0, 0, 0, 0),
    (33, 0.00, 0, 0.00, 18, 0.00, 0, 0, 0, 0, 1, 1), (120, 0.01, 0, 0.00, 0, 0.00, 0, 0, 0, 0, 1, 1), (4, 0.00, 1, 0.00, 3, 0.00, 0, 1, 0, 0, 0, 1),
    (2, 1.00, 1, 0.00, 3, 0.00, 1, 1, 0, 1, 0, 0), (65, 0.02, 120, 0.00, 90, 0.00, 1, 0, 0, 0, 1, 0), (20, 0.00, 20, 0.00, 20, 0.00, 1, 1, 0, 0, 1, 0),
    # Inside an article, whatever comes before or after: paragraphs, short ones, headings, link-only ones.
    *((w, own, *near, 0, 1, h, 0, s, 1) for w, own, h in ((90, 0.00, 0), (15, 0.10, 0), (3, 0.00, 0), (5, 0.00, 1), (6, 1.00, 0)) for near in NEAR + ENDS for s in (0, 1)),
    *((w, 1.00, *near, 0, 1, 0, 0, 0, 1) for w in (1, 3) for near in NEAR + ENDS),
    # Lists of links in an article: references have some words each, menus have not.
    *((w, 1.00, *near, 0, 1, 0, 1, s, int(w > 3)) for w in (1, 2, 3, 4, 5, 9, 20) for near in NEAR + ENDS for s in (0, 1)),
    # Outside of one: paragraphs.
    *((w, own, *near, 0, 0, 0, 0, s, 1) for w, own in ((60, 0.00), (25, 0.05), (10, 0.00), (30, 0.30)) for near in NEAR + ENDS for s in (0, 1)),
    # Longer link-only blocks and short links, if they stand in running text.
    *((w, own, *near, 0, 0, 0, 0, s, int(min(near[0], near[2]) > 9 and max(near[1], near[3]) < 0.5)) for w, own in ((25, 0.90), (12, 0.80), (8, 1.00), (2, 1.00), (1, 1.00)) for near in NEAR + ENDS for s in (0, 1)),
    # Short plain blocks: sentences are text; others are if plain blocks are beside them, of which one is long, and something follows.
    *((w, 0.00, *near, 0, 0, 0, 0, 1, 1) for w in (1, 3, 6) for near in NEAR + ENDS),
    *((w, 0.00, *near, 0, 0, 0, 0, 0, int(max(near[0], near[2]) > 9 and max(near[1], near[3]) < 0.5 and near[2] > 0)) for w in (1, 3, 6) for near in NEAR + ENDS),
    # Headings, if what follows is no link; linked ones before a paragraph.
    *((w, 0.00, *near, 0, 0, 1, 0, s, int(near[2] > 0 and near[3] < 0.5)) for w in (1, 2, 6, 14) for near in NEAR + ENDS for s in (0, 1)),
    *((w, 1.00, *near, 0, 0, 1, 0, s, int(near[2] > 9 and near[3] < 0.5)) for w in (1, 2, 6, 14) for near in NEAR + ENDS for s in (0, 1)),
    # Lists of links, and whatever is outside by its place or name.
    *((w, 1.00, *near, 0, 0, 0, 1, s, 0) for w in (1, 2, 9) for near in NEAR + ENDS for s in (0, 1)),
    *((w, own, *near, 1, i, h, 0, s, 0) for w, own, h in ((3, 0.00, 0), (40, 0.00, 0), (4, 1.00, 0), (4, 0.00, 1)) for i in (0, 1) for near in NEAR + ENDS for s in (0, 1)),
]


def named_outside(tag: str, classes: str, id_: str, inside: bool) -> bool:
    """Whether an element's class or id puts it outside the main text; ``inside``: it is in an article or main element."""
    if inside:
        return any(UNMISTAKABLE.fullmatch(n) for n in classes.split()) or tag != "section" and tag not in HEADINGS and bool(UNMISTAKABLE.fullmatch(id_.strip()))
    names = classes.split() if tag in HEADINGS else [*classes.split(), *id_.split()]
    return any(NAMES.fullmatch(n) or HEADERS.fullmatch(n) for n in names)


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    outside: bool
    inside: bool
    heading: bool
    link_list: bool
    form: int = -1


class Tag(NamedTuple):
    ending: bool
    name: str
    attributes: str
    end: int


class Scanner:
    """Finds the tags of a page, in time linear in its length whatever is left open."""

    def __init__(self, page: str):
        self.page, self.quotes = page, True

    def tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag whose attributes begin at ``at``, or -1. Where a quoted value never ends, quotes do not count from there on."""
        where, page = at, self.page
        while self.quotes and (stop := TAG_STOP.search(page, where)):
            if stop[0] == ">":
                return stop.start()
            value = VALUE.match(page, stop.end()).end()
            if page[value : value + 1] in ('"', "'") and page[value : value + 1]:
                where = page.find(page[value], value + 1) + 1
                if not where:
                    break
            elif end := VALUE_END.search(page, value):
                if end[0] == ">":
                    return end.start()
                where = end.end()
            else:
                return -1
        else:
            if self.quotes:
                return -1
        self.quotes = False
        return page.find(">", at)

    def markup(self, at: int) -> Tag | int | None:
        """What begins at the ``<`` at ``at``: a tag, the end of a comment or declaration, or None for plain text."""
        page = self.page
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            return end + 3 if end >= 0 else len(page)
        if page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            return end + 1 if end >= 0 else len(page)
        name = NAME.match(page, at + 1)
        if name is None:
            return None
        end = self.tag_end(name.end())
        return Tag(bool(name[1]), name[2].lower(), page[name.end() : end], end + 1) if end >= 0 else None


class Open:
    """The open elements, with counts, so that no question about them takes longer the deeper they are."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool, bool]] = []  # tag, silent, outside
        self.of: Counter = Counter()
        self.near: list[Counter] = [Counter()]  # tags above each element of SCOPE
        self.silent = self.outside = self.inside = self.headings = 0

    def _count(self, tag: str, silent: bool, outside: bool, by: int) -> None:
        self.of[tag] += by
        self.silent += by * silent
        self.outside += by * outside
        self.inside += by * (tag in ("article", "main"))
        self.headings += by * (tag in HEADINGS)

    def push(self, tag: str, silent: bool, outside: bool) -> None:
        self.stack.append((tag, silent, outside))
        self._count(tag, silent, outside, 1)
        if tag in SCOPE:
            self.near.append(Counter())
        else:
            self.near[-1][tag] += 1

    def pop_to(self, tag: str) -> None:
        """Close the last open element of this tag and all in it; none if an element of SCOPE is between."""
        if not (self.of[tag] if tag in SCOPE else self.near[-1][tag]):
            return
        last = None
        while last != tag:
            last, silent, outside = self.stack.pop()
            self._count(last, silent, outside, -1)
            if last in SCOPE:
                self.near.pop()
            else:
                self.near[-1][last] -= 1


def blocks_of(page: str) -> list[Block]:
    """The flat text blocks of a page, in order."""
    out: list[Block] = []
    scan, now = Scanner(page), Open()
    text: list[str] = []
    links: list[str] = []
    controls: list[int] = []  # of each form
    form = -1

    def close() -> None:
        joined = SPACES.sub(" ", "".join(text)).strip()
        if joined:
            n, linked = len(joined.split()), len("".join(links).split())
            out.append(Block(joined, n, min(n, linked), now.outside > 0, now.inside > 0, now.headings > 0, now.of["li"] > 0 and linked >= n, form if now.of["form"] else -1))
        text.clear(), links.clear()

    def say(raw: str) -> None:
        if not raw:
            return
        if now.stack and now.stack[-1][0] == "head" and raw.strip():
            now.pop_to("head")
        if not now.silent:
            plain = html.unescape(raw)
            text.append(plain)
            if now.of["a"]:
                links.append(plain + " ")

    at = said = 0  # text up to ``said`` is done
    while (at := page.find("<", at)) >= 0:
        found = scan.markup(at)
        if found is None:
            # Plain text. Without any further ">" there is no tag any more.
            if page.find(">", at) < 0:
                break
            at += 1
            continue
        say(page[said:at])
        if isinstance(found, int):
            at = said = found
            continue
        at = said = found.end
        tag, attributes = found.name, found.attributes
        if tag == "br":
            say(" ")
            continue
        if now.of["head"] and not found.ending and tag not in HEAD_TAGS:
            now.pop_to("head")
        if tag in BLOCK_TAGS:
            close()
        if found.ending:
            now.pop_to(tag)
            continue
        if tag in ENDS_P and now.of["p"]:
            now.pop_to("p")
        if tag in ("li", "dd", "dt", "td", "th", "tr", "option"):
            now.pop_to(tag)
        # Of attributes of one name, the first counts.
        own = {k.lower(): v.strip("\"'").lower() for k, v in reversed(ATTRIBUTE.findall(attributes))} if attributes else {}
        if tag == "form" and not now.of["form"]:
            controls.append(0)
            form += 1
        elif tag in CONTROLS and now.of["form"] and own.get("type") != "hidden":
            controls[form] += 1
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in BLOCK_TAGS:
            continue
        inside = now.inside > 0
        outside = tag in OUTSIDE or tag == "header" and not inside
        outside |= bool(own) and (own.get("role", "") in ROLES or tag not in ("html", "body", "article", "main") and named_outside(tag, own.get("class", ""), own.get("id", ""), inside))
        silent = tag in SILENT or "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "")
        if tag in RAW:
            # Raw text ends with its own end tag only.
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = said = end.end() if end else len(page)
            continue
        now.push(tag, silent, outside)
    say(page[said:])
    close()
    words = Counter()
    for b in out:
        words[b.form] += b.words
    return [b._replace(outside=True) if b.form >= 0 and words[b.form] <= WORDS_A_CONTROL * max(1, controls[b.form]) else b for b in out]


def features(blocks: list[Block]) -> np.ndarray:
    words = np.array([b.words for b in blocks], dtype=float)
    density = np.array([b.linked / b.words for b in blocks])
    shift = lambda x, by: np.concatenate([[0.0], x[:-1]]) if by < 0 else np.concatenate([x[1:], [0.0]])
    flags = np.array([(b.outside, b.inside, b.heading, b.link_list, bool(SENTENCE.search(b.text))) for b in blocks], dtype=float)
    return np.column_stack([words, density, shift(words, -1), shift(density, -1), shift(words, 1), shift(density, 1), flags])


def trained(rows: list[tuple] = LABELLED, depth: int = 12) -> tuple | float:
    """A decision tree by Gini impurity: (feature, bound, tree at or below it, tree above it), or the share of content in a leaf."""
    x, y = np.array([r[:-1] for r in rows], dtype=float), np.array([r[-1] for r in rows], dtype=float)

    def grow(at: np.ndarray, left: int) -> tuple | float:
        share = y[at].mean()
        if left == 0 or share in (0.0, 1.0):
            return float(share)
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[at, f])
            for cut in (values[:-1] + values[1:]) / 2:
                low = x[at, f] <= cut
                a, b = y[at][low], y[at][~low]
                impurity = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
                # Of equal splits the earlier feature, and so the plainer one, does.
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, f, float(cut))
        if best is None or best[0] >= len(at) * share * (1 - share) - 1e-12:
            return float(share)
        low = x[at, best[1]] <= best[2]
        return best[1], best[2], grow(at[low], left - 1), grow(at[~low], left - 1)

    return grow(np.arange(len(y)), depth)


def content(tree: tuple | float, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree >= 0.5)
    f, cut, low, high = tree
    return np.where(x[:, f] <= cut, content(low, x), content(high, x))


def main_text(page: str | None, tree: tuple | float) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    keep = content(tree, features(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``. No shuffle: each page is a row's own work."""
    tree = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, tree) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
