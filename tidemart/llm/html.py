"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level tags. The first pass labels a block by what it
stands in (menus, forms, adverts, ...), by link density, and by length and stop-word
density; short blocks and long ones with few stop words stay undecided. In the second pass
undecided blocks take the label of the nearest decided block of their region. A page with
an ``article`` or ``main`` element has its text there, and everything outside is boilerplate.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemart.llm.common import slices

# Tags, names and words the rules look for.
RAW = "script|style|noscript|template|svg|iframe|textarea|select|title|math|object|canvas"
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu "
    "nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that end where the next one of the group starts.
SELF_CLOSING = {t: g for g in (
    ("p", *sorted(HEADING)), ("li",), ("dt", "dd"), ("td", "th"), ("tr",), ("option",)) for t in g}
BAD_TAGS = frozenset("nav footer aside form menu dialog button fieldset head".split())
BAD_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert menu menubar form".split())
BAD_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion promoted sponsor "
    "sponsored sidebar side rail menu nav navbar navigation breadcrumb breadcrumbs pagination "
    "pager footer masthead cookie cookies consent gdpr privacy notice notices alert newsletter "
    "subscribe subscription signup login popup modal overlay toolbar social share sharing "
    "comment comments respond disqus related recommended trending widget copyright legal "
    "disclaimer skip search".split())
#: A name with one of the first tells what the page has, not what the element is; one that
#: ends with one of the second, and starts well, surrounds the main text too.
STATE_NAMES = frozenset("no has with without".split())
AROUND_NAMES = frozenset("wrap wrapper layout container grid row".split())
STOP_WORDS = frozenset((
    "a an and are as at be been but by can for from had has have he her his if in into is it its "
    "not of on or she so than that the their them they this to was we were which who will with "
    "you "
    "als am auch auf aus bei bin das dass dem den der des die du ein eine einem einen einer er es "
    "für hat ich ihr im ist man mit nach nicht noch sich sie sind so über und von vor war was "
    "wenn wie wir zu zum zur "
    "au aux avec ce cette ces dans de du elle en est et eux il ils je la le les leur lui mais ne "
    "nous ou par pas pour qu que qui sa sans ses son sont sur un une vous "
    "al como con del el ella en entre era es esta este ha hay las lo los más me mi muy no o para "
    "pero por se si sin sobre su sus también una y ya").split())

SHORT, LONG = 70, 200
STOP_LOW = 0.1
MAX_LINKS = 1 / 3

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
    r"""((?:"[^"]*"|'[^']*'|[^'">])*+)(?:>|[^>]*>|[^>]*\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.DOTALL | re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""",
                        re.IGNORECASE)


_COPYRIGHT = re.compile("(?:copyright *)?\N{COPYRIGHT SIGN}", re.IGNORECASE)


@dataclass(slots=True)
class Block:
    tag: str
    bad: bool
    region: int
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _bad_names(attributes: str, inside: bool) -> bool:
    """Whether class, id or role name boilerplate."""
    for name, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        name = name.lower()
        if name == "hidden" or name == "role" and value in BAD_ROLES:
            return True
        for word in value.split() if name in ("class", "id") else ():
            parts = [p for p in re.split(r"[^a-z]+", word) if p]
            bad = BAD_NAMES.union(() if inside else ("header",)).intersection(parts)
            if bad and not STATE_NAMES.intersection(parts) and not (
                    parts[-1] in AROUND_NAMES and parts[0] not in bad):
                return True
    return False


def blocks(html: str) -> list[Block]:
    """Blocks with text, in page order. ``region`` counts article and main elements, 0 is
    outside of them."""
    out: list[Block] = []
    # open elements: tag, boilerplate, region
    stack: list[tuple[str, bool, int]] = [("", False, 0)]
    held: Counter[str] = Counter()
    regions, links = 0, 0
    current = Block("", False, 0)

    def begin(tag: str) -> Block:
        if current.parts and current.text:
            out.append(current)
        return Block(tag, stack[-1][1], stack[-1][2])

    def close(tag: str) -> None:
        nonlocal links
        while stack[-1][0] != tag:
            held[stack.pop()[0]] -= 1
        held[stack.pop()[0]] -= 1
        if len(stack) < links:
            links = 0       # a link ends with the element it started in

    def say(text: str) -> None:
        text = unescape(text)
        current.parts.append(text)
        if links:
            current.linked += len("".join(text.split()))

    at = 0
    for match in _TOKEN.finditer(html):
        if match.start() > at:
            say(html[at:match.start()])
        at = match.end()
        tag = (match[3] or "").lower()
        if not tag:
            continue
        if tag == "a":
            links = 0 if match[2] else len(stack)
        elif tag == "br":
            current.parts.append("\n")
        elif tag in BLOCK:
            group = SELF_CLOSING.get(tag)
            if match[2]:
                if held[tag]:
                    close(tag)
            else:
                # an open paragraph ends at any block, a list item or cell at the next one
                if stack[-1][0] in SELF_CLOSING and (
                        stack[-1][0] in ("p", *HEADING) or SELF_CLOSING[stack[-1][0]] == group):
                    close(stack[-1][0])
                _, bad, region = stack[-1]
                if tag in ("article", "main") and not bad and not region:
                    regions += 1
                    region = regions
                bad = bad or tag in BAD_TAGS or tag == "header" and not region or (
                    tag not in ("html", "body", "main") and _bad_names(match[4], region > 0))
                if tag not in VOID:
                    stack.append((tag, bad, region))
                    held[tag] += 1
            current = begin("" if match[2] else tag)
    if at < len(html):
        say(html[at:])
    begin("")
    return out


def _first_label(block: Block, text: str) -> bool | None:
    """True for main text, False for boilerplate, None for undecided."""
    if block.bad:
        return False
    size = len(text.replace(" ", ""))
    if block.linked > MAX_LINKS * size:
        return False
    if len(text) < LONG and _COPYRIGHT.search(text) and (
            not block.region or _COPYRIGHT.match(text)):
        return False
    if len(text) < SHORT:
        return None
    words = [w.strip(".,;:!?()\"'").lower() for w in text.split()]
    stops = sum(w in STOP_WORDS for w in words)
    return True if stops >= STOP_LOW * len(words) else None


def _inside(found: list[tuple[Block, str]], labels: list[bool | None]) -> bool:
    """Whether the article and main elements hold most of what reads like main text."""
    inside = any(b.region and not b.bad for b, _ in found)
    size = [0, 0]
    for (block, text), label in zip(found, labels):
        if label:
            size[block.region > 0] += len(text)
    return inside and size[1] >= size[0]


def main_text(html: str) -> str:
    found = [(b, b.text) for b in blocks(html)]
    labels = [_first_label(b, t) for b, t in found]
    narrow = _inside(found, labels)
    if narrow:
        kept = [i for i, (b, _) in enumerate(found) if b.region]
        found, labels = [found[i] for i in kept], [labels[i] for i in kept]
    decided = [i for i, label in enumerate(labels) if label is not None
               and not (narrow and found[i][0].bad)]
    keep = []
    for i, ((block, text), label) in enumerate(zip(found, labels)):
        if label is None:
            at = bisect_left(decided, i)
            before = decided[at - 1] if at else None
            after = decided[at] if at < len(decided) else None
            if narrow:
                # text of an article is dropped between two blocks that are boilerplate
                label = before is None or after is None or labels[before] or labels[after]
            elif before is after is None or not any(labels):
                label = bool(block.tag)     # nothing reads like main text: its blocks count
            elif before is None or after is None or block.tag in HEADING:
                label = labels[after if after is not None else before]
            elif i - before == after - i:
                label = labels[before] and labels[after]
            else:
                label = labels[before if i - before < after - i else after]
        if label:
            keep.append(text)
    return "\n".join(keep)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """``key, url, text, n_chars`` for each row of ``pages``.

    A null or empty page, and one without main text, has an empty text. Repeated rows and
    null keys stay; other columns are ignored; an empty table gives no rows; pages of any length
    are read whole. Rows are read where they are, without a shuffle, one page at a time.
    """
    schema = T.StructType([pages.schema[key], pages.schema[url],
                           T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            texts = [main_text(h or "") for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], names=schema.names)

    return pages.select(key, url, html).mapInArrow(run, schema)
