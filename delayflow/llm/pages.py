"""Main text of web pages by block rules in two passes."""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from delayflow.llm.arrow import slices

# Densities and lengths of the first pass.
LINK_DENSITY = 0.5
SHORT = 70
LONG = 200
STOPS_LOW = 0.15
STOPS_HIGH = 0.30
# A paragraph of the marked article is only a menu if it is nearly all links.
ARTICLE_LINK_DENSITY = 0.8

# Frequent words of the languages at hand.
STOP_WORDS = frozenset(
    """
a about after all also an and any are as at be been but by can could did do for from had has have he
her his how i if in into is it its just like may more most my no not of on one only or other our out
over said she so some such than that the their them then there these they this to up was we were what
when which who will with would you your
au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur lui mais ne nous
on ou par pas plus pour qu que qui sa sans se ses son sont sur un une vous y
aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer
er es für hat ich ihr im in ist kann man mit nach nicht noch nur oder sein sich sie sind so über um
und unter vom von vor war was wie wir wird zu zum zur
al como con cuando de del desde donde el ella en entre era es esta este ha hay la las lo los más me mi
muy no nos o para pero por porque que se si sin sobre son su sus también tiene un una y ya
    """.split()
)

# Kinds of elements.
RAW = "script|style|textarea|title"
SKIPPED = frozenset("noscript template select svg math iframe object canvas button".split())
BLOCKS = frozenset(
    """
address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol option p pre section
summary table tbody td tfoot th thead tr ul
    """.split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that hold no main text wherever they stand, and those that hold none outside of it.
STRONG = frozenset("nav aside footer menu dialog".split())
WEAK = frozenset("header form fieldset label legend option".split())
MAIN = frozenset("article main".split())
# How a name shuts an element out: as a whole class or id, or as a part of one with hyphens.
WHOLE, PART = 2, 1
STRONG_ROLES = frozenset("navigation contentinfo complementary menu menubar toolbar dialog alertdialog".split())
WEAK_ROLES = frozenset("banner search form alert".split())
STRONG_NAMES = frozenset(
    """
ad ads adbox advert adverts advertisement advertisements adsense sponsor sponsored promo promotion comment
comments commentlist disqus reply replies respond nav navbar navigation menu menus breadcrumb breadcrumbs
sidebar aside footer related recommended cookie cookies consent gdpr notice notices newsletter subscribe
share sharing social popup modal overlay pagination pager
    """.split()
)
WEAK_NAMES = frozenset("header masthead banner toolbar login signup form search widget alert skip copyright legal".split())
# Names of marked articles that are not the page's own.
FOREIGN = frozenset("comment comments related ad advert".split())

# A value in quotes ends before the next element at the latest, so that a quote without its other
# half costs no look at the rest of the page.
_ATTRS = r"(?:[^>\"']|\"[^\"<]*\"|'[^'<]*')*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    rf"|<(?P<raw>{RAW})\b{_ATTRS}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>{_ATTRS})>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*)>|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_SKIP_END = re.compile(rf"</({'|'.join(sorted(SKIPPED))})\s*>", re.IGNORECASE)
_ATTR = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME = re.compile(r"[^a-z0-9]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    """A run of text between block elements, and where it stands."""

    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    excluded: bool = False
    article: bool = False
    names: tuple[tuple[int, int], ...] = ()
    lifted: int = 0
    doubtful: bool = False
    text: str = ""

    def finish(self) -> None:
        self.text = " ".join("".join(self.parts).split())


@dataclass(frozen=True)
class Place:
    """An open element: whether it shuts its text out, and whether it marks main text.

    ``names`` are the number and kind of the elements around whose name alone does so, of
    which the first ``lifted`` have a marked article inside; ``_settle`` decides on them.
    """

    tag: str
    excluded: bool = False
    strong: bool = False
    article: bool = False
    names: tuple[tuple[int, int], ...] = ()
    lifted: int = 0


def _place(tag: str, attrs: str, above: Place | None, number: int = 0) -> Place:
    excluded = above.excluded if above else False
    named, lifted = (above.names, above.lifted) if above else ((), 0)
    strong = above.strong if above else False
    article = above.article if above else False
    values = {}
    if attrs.strip():
        for name, a, b, c in _ATTR.findall(attrs):
            values[name.lower()] = (a or b or c).lower()
    role = values.get("role", "")
    whole = (values.get("class", "") + " " + values.get("id", "")).split()
    names = set(_NAME.split(" ".join(whole)))
    marks = tag in MAIN or role in ("main", "article") or values.get("itemprop") == "articlebody"
    hidden = (
        "hidden" in values
        or values.get("aria-hidden") == "true"
        or re.search(r"display\s*:\s*none", values.get("style", "")) is not None
    )
    plain = tag not in ("html", "body")
    if hidden or tag in STRONG or role in STRONG_ROLES:
        excluded = strong = True
    elif plain and names & STRONG_NAMES and not marks:
        named += ((number, WHOLE if STRONG_NAMES.intersection(whole) else PART),)
    elif marks and FOREIGN.intersection(whole):
        excluded = strong = True
    elif marks and not strong:
        # Main text inside a form, a header or the like that wraps the page.
        excluded, article, lifted = False, True, len(named)
        if names & FOREIGN:
            named += ((number, PART),)
    elif not article and (tag in WEAK or role in WEAK_ROLES or (plain and WEAK_NAMES.intersection(whole))):
        excluded = True
    elif not article and plain and names & WEAK_NAMES:
        named += ((number, PART),)
    elif article and tag in ("form", "fieldset", "label", "legend", "option"):
        excluded = True
    return Place(tag, excluded, strong, article, named, lifted)


def _tokens(page: str) -> Iterator[tuple[re.Match, int, bool]]:
    """Matches of markup in order, where each ends, and whether its text is skipped.

    The ends of skipped elements are found once; an element without one is a tag like others.
    """
    ends: dict[str, list[int]] | None = None
    at = 0
    while match := _TOKEN.search(page, at):
        at, skipped = match.end(), match["raw"] is not None
        tag = (match["tag"] or match["tag2"] or "").lower()
        if tag in SKIPPED and not (match["close"] or match["close2"]):
            if ends is None:
                ends = {}
                for end in _SKIP_END.finditer(page):
                    ends.setdefault(end[1].lower(), []).append(end.end())
            places = ends.get(tag, [])
            place = bisect_right(places, at)
            if place < len(places):
                at, skipped = places[place], True
        yield match, at, skipped


def blocks_of(page: str) -> list[Block]:
    """The non-empty text blocks of a page in order. Broken markup does not stop it: an end tag
    without a start is passed over, open elements end with what encloses them."""
    found: list[Block] = []
    stack: list[Place] = []
    block = Block()
    in_link = breaks = 0

    def end_block() -> None:
        nonlocal block
        block.finish()
        if block.text:
            found.append(block)
        top = stack[-1] if stack else None
        block = Block()
        if top:
            block.excluded, block.article = top.excluded, top.article
            block.names, block.lifted = top.names, top.lifted

    def add(text: str) -> None:
        nonlocal breaks
        if not text:
            return
        text = html.unescape(text)
        block.parts.append(text)
        if not text.isspace():
            breaks = 0
            if in_link:
                block.link_chars += len(" ".join(text.split()))

    at = 0
    for match, end, skipped in _tokens(page):
        add(page[at : match.start()])
        at = end
        if skipped:
            continue
        tag = match["tag"] or match["tag2"]
        if not tag:
            if match[0].startswith("<![CDATA["):
                add(html.escape(match[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        closing = match["close"] or match["close2"]
        if tag == "br":
            breaks += 1
            if breaks > 1:
                end_block()
            else:
                block.parts.append(" ")
        elif tag == "a":
            in_link = 0 if closing else 1
        elif closing:
            if tag in BLOCKS:
                _leave(stack, tag)
                end_block()
            elif any(p.tag == tag for p in stack):
                _leave(stack, tag)
                end_block()
        elif tag in BLOCKS:
            if tag == "p":
                while stack and stack[-1].tag == "p":
                    stack.pop()
            elif tag in ("li", "td", "th", "tr", "dt", "dd") and stack and stack[-1].tag in ("p", tag):
                _leave(stack, tag, within=2)
            if tag not in VOID:
                stack.append(_place(tag, match["attrs"] or match["attrs2"] or "", stack[-1] if stack else None, at))
            in_link = 0
            end_block()
        elif tag not in VOID:
            attrs = match["attrs"] or match["attrs2"] or ""
            if "hidden" in attrs or "class" in attrs or "display" in attrs or "role" in attrs:
                above = stack[-1] if stack else Place("")
                place = _place(tag, attrs, stack[-1] if stack else None, at)
                if (place.excluded, place.names) != (above.excluded, above.names):
                    stack.append(place)
                    end_block()
    add(page[at:])
    stack.clear()
    end_block()
    _settle(found)
    return found


def _settle(blocks: list[Block]) -> None:
    """Shut out what names alone shut out, unless the element wraps the page's main text.

    A marked article inside lifts the exclusion: of a part of a name always, of a whole name
    if no article stands outside. An element named by a part is no menu either if it holds
    the larger part of the text that passes the first pass by itself.
    """
    outside = any(b.article and not b.excluded and not b.names for b in blocks)
    left: list[list[int]] = []
    for b in blocks:
        still = [n for i, n in enumerate(b.names) if i >= b.lifted or n[1] == WHOLE and outside]
        b.excluded = b.excluded or any(kind == WHOLE for _, kind in still)
        left.append([number for number, _ in still])
    good: dict[int, int] = {}
    total = 0
    for b, numbers in zip(blocks, left):
        if first_pass(b):
            total += len(b.text)
            for number in numbers:
                good[number] = good.get(number, 0) + len(b.text)
    for b, numbers in zip(blocks, left):
        b.doubtful = any(2 * good.get(number, 0) <= total for number in numbers)
    # Parts of names do not leave a page without text.
    if any(not b.excluded and not b.doubtful for b in blocks):
        for b in blocks:
            b.excluded = b.excluded or b.doubtful


def _leave(stack: list[Place], tag: str, within: int | None = None) -> None:
    """Close the nearest open ``tag`` and what is open inside it."""
    low = max(0, len(stack) - within) if within else 0
    for i in range(len(stack) - 1, low - 1, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return


def first_pass(block: Block) -> bool | None:
    """Main text, not main text, or None where the block's own counts do not decide."""
    if block.excluded:
        return False
    size = len(block.text)
    density = block.link_chars / size
    if density > (ARTICLE_LINK_DENSITY if block.article else LINK_DENSITY):
        return False
    words = _WORD.findall(block.text.lower())
    stops = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
    if size >= LONG and stops >= STOPS_HIGH:
        return True
    if block.article:
        return True if size >= SHORT and stops >= STOPS_LOW else None
    if size < SHORT:
        return False if block.link_chars else None
    return None if stops >= STOPS_LOW else False


def second_pass(blocks: list[Block], labels: list[bool | None]) -> list[bool]:
    """Undecided blocks take the label of the nearest decided one, of two as near the good one.

    Inside a marked article the nearest decided block of the article counts, and its own mark
    where there is none. Where no block of a page is good, all that are no menus are its text.
    Text outside of marked articles counts only if more of it is good by itself than inside.
    """
    inside = sum(len(b.text) for b, good in zip(blocks, labels) if good and b.article)
    beside = sum(len(b.text) for b, good in zip(blocks, labels) if good and not b.article)
    marked = inside >= beside and any(b.article and not b.excluded for b in blocks)

    def nearest(order) -> dict[int, tuple[int, bool]]:
        out, last = {}, None
        for i in order:
            if labels[i] is not None and not blocks[i].excluded or labels[i] and blocks[i].article:
                last = i
            if last is not None:
                out[i] = (abs(i - last), bool(labels[last]))
        return out

    before, after = nearest(range(len(blocks))), nearest(range(len(blocks) - 1, -1, -1))
    decided = []
    for i, label in enumerate(labels):
        if label is not None:
            decided.append(label)
        elif blocks[i].article:
            # What surrounds it in the article is good unless both sides are menus.
            near = [x[1] for x in (before.get(i), after.get(i)) if x]
            decided.append(not near or any(near) or len(near) < 2)
        else:
            near = sorted(x for x in (before.get(i), after.get(i)) if x)
            good = bool(near) and (near[0][1] or len(near) > 1 and near[1][0] == near[0][0] and near[1][1])
            decided.append(good and not marked)
    if not any(decided):
        decided = [not b.excluded and b.link_chars <= LINK_DENSITY * len(b.text) for b in blocks]
    if marked:
        decided = [d and b.article for d, b in zip(decided, blocks)]
    return decided


def main_text(page: str | None) -> str:
    """Main text of one page, blocks joined by line feeds; empty if there is none."""
    blocks = blocks_of(page or "")
    kept = second_pass(blocks, [first_pass(b) for b in blocks])
    return "\n".join(b.text for b, good in zip(blocks, kept) if good)


def extract_text(pages: DataFrame, html_col: str = "html", out_col: str = "main_text") -> DataFrame:
    """Add the main text of each page; no shuffle, one pass over whole pages.

    NULL and empty pages, and pages without text, give an empty text. Rows and columns are
    kept as they are, repeated ones too; an ``out_col`` that exists is replaced.
    """
    at = pages.columns.index(html_col)
    kept = [c for c in pages.columns if c.lower() != out_col.lower()]
    places = [pages.columns.index(c) for c in kept]
    fields = [*(pages.schema.fields[i] for i in places), T.StructField(out_col, T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = pa.array([main_text(p) for p in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in places), texts], names=[*kept, out_col]
            )

    return pages.mapInArrow(run, T.StructType(fields))
