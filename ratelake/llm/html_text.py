"""Main-text extraction by two-pass block rules (after Pomikalek, 2011).

The page is cut into blocks at block-level tags. Pass one classifies each
block on its own by its length, its density of stop words and its density of
link text, and by what it stands in (navigation, footers, forms, adverts,
comments and the like are boilerplate). Stop words are those of four languages;
blocks in another script than the Latin one are judged by their number of
letters instead. Pass two: blocks too short to decide
inherit the label of their nearest decided neighbours; inside an article or
main element only neighbours in that element count, and of these only the ones that
their own text decided, elsewhere a block between
a good and a bad neighbour stays out unless it is a heading before good text.

Class and id names of a wrapper that tell its layout (has-sidebar, with-comments)
do not make it boilerplate, nor do names of headers inside an article; a main element
is never boilerplate by the names around it.

Defined results: NULL or empty html gives the empty text; a page without any
good block gives the empty text; unclosed elements are tolerated; a tag that the page's
end cuts off is dropped; tags are read in time proportional to their length; text of any
length is kept whole; extra columns are not read; repeated rows are ordinary; no rows give no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Common function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """
    a an and are as at be been but by for from had has have he her his if in into is it its no not of on or she so
    that the their there they this to was we were which who will with you
    aber als am an auch auf aus bei das dass dem den der des die doch durch ein eine einem einen einer er es für hat
    ich ihr im in ist kann mit nach nicht noch nur oder sich sie sind über um und uns vom von vor war was wie wir zu zum zur
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas plus
    pour qu que qui sa se ses son sont sous sur un une vous y
    al como con de del desde el ella en entre era es esta este fue ha hay la las lo los más me mi muy no nos o para pero
    por que se sin sobre son su sus también un una y ya
    """.split()
)
# HTML element names.
BLOCK_TAGS = frozenset(
    """
    address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption
    figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol
    optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul
    """.split()
)
DROPPED_TAGS = frozenset("script style noscript template svg math iframe object embed canvas head title textarea select".split())
RAW_TAGS = frozenset("script style textarea title".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form menu dialog button fieldset search".split())
CONTENT_TAGS = frozenset("article main".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side-?bar|footer|header|masthead"
    r"|cookies?|consent|gdpr|notice|alert|popup|modal|newsletter|subscribe|subscription|signup|login|search|share|sharing|social"
    r"|comments?|replies|respond|disqus|related|recommend\w*|widget|toolbar|pagination|pager|copyright|disclaimer)(?:$|[\s_-])",
    re.IGNORECASE,
)
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)", re.DOTALL
)
ATTRIBUTE = re.compile(r"""(?<![^\s=/"'>])([^\s=/"'>]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]++))""")
LAYOUT_NAMES = re.compile(r"(?<!\S)(?:has|with|without|no|show|hide)[-_]\S*", re.IGNORECASE)
HEADER_NAMES = re.compile(r"(?<!\S)[\w-]*header[\w-]*(?!\S)", re.IGNORECASE)
WORD = re.compile(r"\w+")

GOOD, SHORT, BAD = 1, 0, -1


class Block:
    __slots__ = ("parts", "linked", "boilerplate", "content", "heading", "label", "text")

    def __init__(self, boilerplate: bool, content: int, heading: bool):
        self.parts, self.linked = [], 0
        self.boilerplate, self.content, self.heading = boilerplate, content, heading
        self.label, self.text = SHORT, ""


def _is_boilerplate(tag: str, attributes: str, content: int) -> bool:
    if tag in BOILERPLATE_TAGS and not (tag == "header" and content):
        return True
    if "=" not in attributes and "hidden" not in attributes:
        return False
    found = {name.lower(): next((v for v in values if v), "") for name, *values in ATTRIBUTE.findall(attributes)}
    if found.get("role", "").lower() in BOILERPLATE_ROLES or found.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"(?:^|\s)hidden(?:\s|$)", attributes) or "display:none" in found.get("style", "").replace(" ", "").lower():
        return True
    if tag in CONTENT_TAGS or tag in {"body", "html"}:
        return False
    names = [LAYOUT_NAMES.sub("", found.get(key, "")) for key in ("class", "id")]
    if content:
        names = [HEADER_NAMES.sub("", n) for n in names]
    return any(BOILERPLATE_NAMES.search(n) for n in names)


def blocks_of(page: str) -> list[Block]:
    """The page's non-empty blocks in order, with their surroundings; markup and invisible text are left out."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int, bool]] = []  # tag, boilerplate, number of the content element, dropped
    boilerplate, content, dropped = False, 0, False
    links, contents, skip_raw = 0, 0, ""
    block: Block | None = None
    at = 0

    def text(raw: str) -> None:
        nonlocal block
        if dropped or skip_raw or not raw:
            return
        if block is None:
            if raw.isspace():
                return
            block = Block(boilerplate, content, any(t[0] in HEADINGS for t in stack))
            out.append(block)
        block.parts.append(raw)
        if links:
            block.linked += len(raw)

    for m in TOKEN.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        closing = bool(m[1])
        if skip_raw:
            if not (closing and tag == skip_raw):
                continue
            skip_raw = ""
        if tag == "br":
            text(" ")
            continue
        if tag == "a":
            links = 0 if closing else 1
            continue
        tracked = tag in BLOCK_TAGS or tag in DROPPED_TAGS or tag in BOILERPLATE_TAGS
        names = "" if closing or tag in VOID_TAGS else m[3]
        odd = bool(names) and _is_boilerplate(tag, names, content)
        if not tracked and not odd and not (closing and any(t[0] == tag for t in stack)):
            continue
        if tag in BLOCK_TAGS or odd:
            block, links = None, 0
        if tag in VOID_TAGS:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            block = None
        else:
            if tag in {"p", "li", "dt", "dd", "tr", "td", "th", "option"} or tag in HEADINGS:
                # The end tag of these may be missing: a new one ends an open one of the same kind.
                same = HEADINGS if tag in HEADINGS else {tag}
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in same:
                        del stack[k:]
                        break
                    if stack[k][0] not in {"p"}:
                        break
            if tag in CONTENT_TAGS and not content:
                contents += 1
            inside = stack[-1] if stack else ("", False, 0, False)
            number = inside[2] or (contents if tag in CONTENT_TAGS else 0)
            around = inside[1] and tag != "main"
            stack.append((tag, around or _is_boilerplate(tag, m[3], inside[2]), number, inside[3] or tag in DROPPED_TAGS))
            if tag in RAW_TAGS:
                skip_raw = tag
        _, boilerplate, content, dropped = stack[-1] if stack else ("", False, 0, False)
    text(page[at:])
    return out


def classify(block: Block, min_words: int, stop_density: float, link_density: float) -> int:
    """Pass one: the block by itself."""
    if block.boilerplate:
        return BAD
    size = sum(map(len, block.parts))
    if size and block.linked / size > link_density:
        return BAD
    letters = [] if block.text.isascii() else [c for c in block.text if c.isalpha()]
    if letters and 2 * sum(ord(c) > 0x24F for c in letters) > len(letters):  # not the Latin script: no stop words are known
        return GOOD if len(letters) >= 3 * min_words else SHORT
    words = WORD.findall(block.text.lower())
    if len(words) < min_words:
        return SHORT
    return GOOD if sum(w in STOP_WORDS for w in words) >= stop_density * len(words) else SHORT


def main_text(page: str | None, min_words: int = 10, stop_density: float = 0.1, link_density: float = 0.5) -> str:
    """The page's main text: good blocks in page order, joined by one line feed."""
    blocks = []
    for b in blocks_of(page or ""):
        b.text = " ".join(html.unescape("".join(b.parts)).split())
        if b.text:
            b.label = classify(b, min_words, stop_density, link_density)
            blocks.append(b)
    labels = [b.label for b in blocks]
    before, last = [], {}
    for b, label in zip(blocks, labels, strict=True):  # nearest decided neighbour before, in the same content element
        before.append(last.get(b.content))
        if label and not (b.content and b.boilerplate):
            last[b.content] = label
    after, last = [], {}
    for b, label in zip(reversed(blocks), reversed(labels), strict=True):
        after.append(last.get(b.content))
        if label and not (b.content and b.boilerplate):
            last[b.content] = label
    keep = []
    for b, x, y in zip(blocks, before, reversed(after), strict=True):
        label = b.label
        if label == SHORT:
            if b.content:  # an element that holds the article: only bad neighbours on both sides speak against a block
                label = BAD if (x, y) == (BAD, BAD) else GOOD
            else:
                label = GOOD if (x, y) == (GOOD, GOOD) or (b.heading and y == GOOD) else BAD
        if label == GOOD:
            keep.append(b.text)
    return "\n".join(keep)


def extract(pages: DataFrame, **rules: float) -> DataFrame:
    """page_id, url, text, n_chars for every row of (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, **rules) for h in batch.column(2).to_pylist()]
            sizes = pa.array(list(map(len, texts)), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"]
            )

    kind = dict(pages.dtypes)["page_id"]
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
