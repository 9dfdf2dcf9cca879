"""Main text of web pages by two-pass block rules.

Pass 1 classifies each block on its own: by the container it lies in, its
link density, its length and its share of stop words it is *good*, *bad* or
left *open*.  Words in the class or id of a container are one vote against its
blocks; where they would leave a page with text without any, they do not count.  Pass 2 gives open blocks the label of the nearest decided
neighbours, those of the same article first.  Per page work only: one Arrow
pass over the table, no shuffle.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

# Common function words of the languages expected; a parameter of `extract`.
STOP_WORDS = frozenset(
    # English
    "a an and are as at be by for from had has have he her his i in is it its not of on or she that the their they "
    "this to was we were which will with you "
    # German
    "auch auf aus bei das dem den der des die ein eine einen er es für hat im in ist mit nicht sich sie sind und von "
    "war zu zum zur "
    # French
    "au aux avec ce ces dans de des du elle en est et il je la le les mais ne nous on ou par pas pour qui que se sur "
    "un une vous "
    # Spanish
    "al como con del el ella es esta la las lo los más no para pero por se sin su sus una uno y".split())

MIN_LENGTH = 70          # characters of a block that can be good by itself
STOP_DENSITY = 0.25      # share of stop words of a good block
LINK_DENSITY = 0.5       # share of linked characters of a bad block

_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea iframe svg select button object canvas audio video head title".split())
_CONTENT = frozenset(("article", "main"))
_HOME = frozenset(("article", "main", "section", "div", "td", "aside", "nav", "header", "footer", "form"))
_BOILER = frozenset("nav footer aside form menu dialog".split())
# Words of class and id names.  A name counts if all its parts are such words or
# say where or whose something is; the weak ones not within an article, nor
# together with what they belong to (an article's header is part of it).
_STRONG = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promos promotion banner banners cookie cookies consent "
    "gdpr popup modal newsletter subscribe subscription signup login sidebar sidebars widget widgets menu menus navbar navigation nav "
    "breadcrumb breadcrumbs pagination pager footer masthead toolbar comments replies respond disqus share sharing social related "
    "recommended recommendations teaser teasers copyright disclaimer".split())
_WEAK = frozenset("side header notice notices alert overlay tags legal comment reply".split())
_WHERE = frozenset("box wrap wrapper container block area list bar inner outer top bottom left right main unit slot row col group panel holder "
                   "links buttons form site page global user users reader readers primary secondary".split())
_WHOSE = frozenset("article post entry story blog news".split())
_CONTENT_NAMES = frozenset("content article post entry story text body main article-body post-content entry-content main-content".split())


def _hinted(value: str, article: bool) -> bool:
    names = value.lower().split()
    if any(n in _CONTENT_NAMES for n in names):
        return False
    for name in names:
        parts = [x for x in re.split(r"[-_]+|(?<=[a-z])[0-9]+$", name) if x]
        strong, weak = any(x in _STRONG for x in parts), any(x in _WEAK for x in parts)
        if strong and all(x in _STRONG or x in _WEAK or x in _WHERE or x in _WHOSE for x in parts):
            return True
        if weak and not article and all(x in _WEAK or x in _WHERE for x in parts):
            return True
    return False


_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[^\W\d_]+")


class Block(NamedTuple):
    text: str
    linked: int      # characters inside links
    boiler: bool     # lies in a menu, footer, form ...
    article: bool    # lies in an article
    home: int        # number of the division, section or article around it
    hint: bool = False    # lies in something that its class or id calls an advert, notice, comment ...


def blocks(html: str) -> list[Block]:
    """The text blocks of a page in page order."""
    out: list[Block] = []
    parts: list[str] = []
    stack: list[tuple] = []   # open containers: tag, and the state around them
    boiler, article, home, homes, link, linked, hint = False, False, 0, 0, 0, 0, False
    at, end, unclosed = 0, len(html), set()

    def flush():
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, linked, boiler, article, home, hint))
        parts.clear()
        linked = 0

    for m in iter(lambda: _TOKEN.search(html, at), None):
        if m.start() > at:
            piece = unescape(html[at:m.start()])
            parts.append(piece)
            if link:
                linked += len(piece.strip())
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if not m.group(1):
            if tag == "button" and any(x.strip() for x in parts):
                continue                 # words in the middle of a sentence
            if tag in _RAW:
                if tag in _BLOCK:
                    flush()
                if not m.group(3).rstrip().endswith("/"):
                    close = None if tag in unclosed else re.compile(rf"</{tag}\s*>", re.I).search(html, at)
                    if close:
                        at = close.end()
                    elif tag not in ("head", "title"):
                        at = end
                    else:
                        unclosed.add(tag)
                continue
            if tag in _VOID:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    parts.append(" ")
                continue
            if tag == "a":
                link += 1
                continue
            if tag not in _BLOCK:
                continue
            flush()
            link = 0
            if tag in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "tr", "dt", "dd", "option"):
                if not m.group(3):
                    continue
            stack.append((tag, boiler, article, home, hint))
            if tag in _CONTENT:
                # what was left open before it does not hold the article
                boiler, article, hint = boiler and article, True, hint and article
            if tag in _HOME:
                homes += 1
                home = homes
            hints = {k.lower(): (a or b or c).lower() for k, a, b, c in _ATTR.findall(m.group(3))}
            if tag in _BOILER or tag == "header" and not article or hints.get("role") in _ROLE:
                boiler = True
            elif tag not in _CONTENT and tag not in ("html", "body") and any(_hinted(hints.get(k, ""), article) for k in ("class", "id")):
                hint = True
        else:
            if tag == "a":
                link = max(0, link - 1)
                continue
            if tag not in _BLOCK:
                continue
            flush()
            link = 0
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    _, boiler, article, home, hint = stack[i]
                    del stack[i:]
                    break
                if stack[i][0] in _CONTENT and tag not in _CONTENT and tag not in ("body", "html"):
                    break                # a stray end tag does not close an article
    if at < end:
        parts.append(unescape(html[at:]))
    flush()
    return out


def classify(block: Block, stop_words=STOP_WORDS) -> int:
    """Pass 1: 1 good, -1 bad, 0 open."""
    if block.boiler or block.linked > LINK_DENSITY * len(block.text):
        return -1
    if len(block.text) >= MIN_LENGTH:
        found = _WORD.findall(block.text.lower())
        if found and sum(w in stop_words for w in found) >= STOP_DENSITY * len(found):
            return 1
    return 0


def settle(found: list[Block], labels: list[int]) -> list[bool]:
    """Pass 2: open blocks take the label of the nearest decided neighbours.

    Neighbours in the same division count first.  If the two sides disagree,
    the nearer one wins, and of equally near ones the good one.  Without such
    neighbours, a block in an article is good, and any other takes the label
    of the nearest decided block of the page (good if there is none)."""
    def sweep(order):
        near, last, any_last = {}, {}, None
        for i in order:
            if labels[i]:
                last[found[i].home] = any_last = (i, labels[i])
            else:
                near[i] = (last.get(found[i].home), any_last)
        return near

    before, after = sweep(range(len(found))), sweep(range(len(found) - 1, -1, -1))
    keep = []
    for i, label in enumerate(labels):
        if not label:
            sides = [s for s in (before[i][0], after[i][0]) if s]
            if not sides and not found[i].article:
                sides = [s for s in (before[i][1], after[i][1]) if s]
            label = min(((abs(i - at), -to) for at, to in sides), default=(0, -1))[1] * -1
        keep.append(label > 0)
    return keep


def main_text(html: str | None, stop_words=STOP_WORDS) -> str:
    found = blocks(html or "")
    plain = [classify(b, stop_words) for b in found]
    labels = [-1 if b.hint else x for b, x in zip(found, plain)]
    if 1 not in labels and 1 in plain:
        labels = plain                   # names alone do not empty a page
    if any(b.article for b in found):
        # a page that marks its article has its main text there
        labels = [x if b.article else -1 for b, x in zip(found, labels)]
    return "\n".join(b.text for b, k in zip(found, settle(found, labels)) if k)


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text", stop_words=STOP_WORDS) -> DataFrame:
    """``pages`` with ``out_col``: the main text of the whole html.

    Blocks are joined in page order by one newline; inside a block character
    references are decoded and white space is one space.  Null or empty html
    and pages without main text give an empty string.  Every other column is
    kept, save one that already bears the name ``out_col``: it is replaced.
    Repeated rows repeat; an empty table gives no rows.
    """
    ship(pages.sparkSession)
    pages = pages.drop(out_col) if out_col != html_col else pages
    names = [*[c for c in pages.columns if c != html_col or out_col != html_col], out_col]

    def run(batches):
        for batch in batches:
            html = batch.column(batch.schema.get_field_index(html_col))
            text = pa.array([main_text(x.as_py(), stop_words) for x in html], pa.string())
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, text], names=names)

    schema = pages.select(*names[:-1], F.lit("").alias(out_col)).schema
    return pages.mapInArrow(run, schema)
