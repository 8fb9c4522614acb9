"""HTML extraction: blocks of a page are judged by stop words, length and links, ambiguous ones by their neighbours.

First pass, each block by itself: blocks in containers that hold no article text (by tag, role, class or id) are bad;
link-dense blocks are ambiguous if short and bad otherwise; short blocks are ambiguous; longer ones are good if dense in
stop words, bad if almost without, and ambiguous between. Where a page has hardly any of the known stop words, its
language is another, and length and links alone decide. Inside the page's article (unless it is a mere teaser) low
densities only make a block ambiguous. Second pass: runs of ambiguous blocks take the label of the nearest decided block
on either side; where these differ or there is none, an ambiguous block is good if it lies in the article, and on a page
without any good block those without many links are its text.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelsift.llm.words import in_batches, unused

#: elements whose content is never shown as text, or is a control.
SILENT = frozenset("script style title textarea noscript template iframe svg object canvas annotation audio video select button option datalist".split())
#: of these, elements whose content is not markup.
RAW = frozenset("script style title textarea noscript iframe".split())
#: elements that hold no article text.
ASIDE = frozenset("nav header footer aside form menu dialog fieldset head".split())
#: ARIA roles that hold no article text.
ASIDE_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert alertdialog menu menubar toolbar form status".split())
#: words in class and id attributes that mark such containers.
ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert "
    "sidebar side aside menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar comment comments commentlist respond reply replies disqus "
    "share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay widget toolbar pagination pager skip".split()
)
#: Words in class and id attributes that say that what follows a mark is not there, and of containers of the text itself.
NO_MARK, CONTENT_NAMES = frozenset("has no not with without hide hidden".split()), frozenset("content article post entry main story body text".split())
#: elements that begin and end a block.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup "
    "hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: frequent words of English, French, German and Spanish.
STOP = frozenset(
    "the of and to in a is that it for on with as was be by at are this from or an he his not which but have had they you we she her their its were been has "
    "le la les de des du et un une que qui dans pour par sur pas est avec au aux en ce il elle ne se plus son sa ses nous vous ils ou mais sont "
    "der die das und den von zu mit sich auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie "
    "el los las y del se por con no una su para lo como más pero sus al o este sí porque esta entre cuando muy sin sobre también me hasta hay donde".split()
)
#: Code points under which a block is short, the shares of stop words over and under which longer ones are good and bad, the share of link text.
SHORT, STOP_HIGH, STOP_LOW, LINK_SHARE = 70, 0.25, 0.08, 0.5
#: The share of stop words of a whole page under which its language is none of those known.
KNOWN_SHARE = 0.04
#: The text of article elements that makes them the page's article, as a share of what is outside.
ARTICLE_SHARE = 0.15

# a quoted value is looked for over 4096 characters; where it isn't closed, and in a broken tag, the tag ends at the next
# > or before the next <, so no part of a page is read more than a few times
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*+>?|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/<>]*+)"
    r"(?:(?P<attrs>(?:[^<>\"']++|\"[^\"]{0,4096}+\"|'[^']{0,4096}+')*+)>|(?P<broken>[^<>]*+)>?)",
    re.S,
)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[^a-z]+")
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
#: An element that begins ends open ones of the second kind, up to one of the third.
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}


class Block(NamedTuple):
    text: str
    linked: int
    aside: bool
    article: bool


class Open(NamedTuple):
    """An open element: its tag, and what holds inside it."""

    tag: str
    aside: bool
    article: bool
    silent: bool


def _marked(attrs: str) -> bool:
    """Whether role, class, id or style say that an element holds no article text."""
    for name, *values in _ATTR.findall(attrs):
        words = _NAME.split("".join(values).lower())
        if name.lower() == "role":
            if "".join(values).strip().lower() in ASIDE_ROLES:
                return True
        elif CONTENT_NAMES.isdisjoint(words) and any(w in ASIDE_NAMES and (i == 0 or words[i - 1] not in NO_MARK) for i, w in enumerate(words)):
            return True
    return bool(_HIDDEN.search(attrs))


def _is_aside(tag: str, attrs: str, article: bool) -> bool:
    if tag in ASIDE and not (tag == "header" and article):  # an article's own header has its title
        return True
    if not attrs or tag in ("html", "body", "article", "main") and not re.search("comment", attrs, re.I):
        return False
    return _marked(attrs)


def blocks(page: str) -> Iterator[Block]:
    """The page's blocks in order, with white space collapsed and character references decoded. Time is linear in the page."""
    top = Open("", False, False, False)
    stack: list[Open] = [top]
    inside: Counter[str] = Counter()  # open elements by tag
    link = False
    shown: list[tuple[str, bool]] = []

    def flush() -> Iterator[Block]:
        nonlocal shown
        text = " ".join("".join(x for x, _ in shown).split())
        if text:
            yield Block(text, sum(len(x.strip()) for x, on in shown if on), stack[-1].aside, stack[-1].article)
        shown = []

    def pop() -> None:
        inside[stack.pop().tag] -= 1

    at = 0
    while at <= len(page):
        m = _TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if end > at and not stack[-1].silent:
            shown.append((entities.unescape(page[at:end]), link))
        if not m:
            break
        at = m.end()
        if m["cdata"] is not None and not stack[-1].silent:
            shown.append((m["cdata"], link))
        if not m["tag"]:
            continue
        tag, close, attrs = m["tag"].lower(), bool(m["close"]), m["attrs"] or m["broken"] or ""
        if not close and tag in RAW and not attrs.rstrip().endswith("/"):
            over = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = over.end() if over else len(page)
            if tag == "noscript" or tag in BLOCK:
                yield from flush()
            continue
        if tag == "a":
            link = not close
        elif tag in ("br", "wbr"):
            shown.append((" " if tag == "br" else "", False))
        elif tag in VOID and tag != "hr":
            continue
        elif tag in BLOCK or tag in SILENT or tag == "span":
            if tag in BLOCK:
                yield from flush()
                link = False
            if tag in VOID:
                continue
            if close:
                while inside[tag] and stack[-1].tag != tag:
                    pop()
                if inside[tag]:
                    pop()
                continue
            if tag in BLOCK and stack[-1].tag == "p":  # an open paragraph ends where another block begins
                pop()
            if tag in _IMPLIED:
                ended, until = _IMPLIED[tag]
                while any(inside[x] for x in ended):
                    k = next(i for i in range(len(stack) - 1, -1, -1) if i == 0 or stack[i].tag in ended or stack[i].tag in until)
                    if stack[k].tag not in ended:
                        break
                    while len(stack) > k:
                        pop()
            elif tag in BLOCK and stack[-1].tag == "li" and not (inside["ul"] or inside["ol"] or inside["menu"]):
                pop()  # an item outside any list holds no other blocks
            own = stack[-1]
            if tag == "span":
                stack.append(Open(tag, own.aside, own.article, own.silent or bool(attrs) and _marked(attrs)))
            else:
                stack.append(Open(tag, own.aside or _is_aside(tag, attrs, own.article), own.article or tag in ("article", "main"), own.silent or tag in SILENT))
            inside[tag] += 1
    yield from flush()


def _stop_words(text: str) -> tuple[int, int]:
    words = [x.strip(".,;:!?\"'()[]*%$#&|").lower() for x in text.split()]
    return sum(x in STOP for x in words), len(words)


def _first_pass(found: list[Block], has_article: bool) -> list[bool | None]:
    """Each block's label by itself: good, bad or ambiguous (None)."""
    counts = [_stop_words(x.text) for x in found]
    known = sum(n for n, _ in counts) >= KNOWN_SHARE * sum(n for _, n in counts)
    labels: list[bool | None] = []
    for x, (stop, words) in zip(found, counts, strict=True):
        inner, short, share = has_article and x.article, len(x.text) < SHORT, stop / max(1, words)
        if x.aside or has_article and not x.article:
            labels.append(False)
        elif x.linked > LINK_SHARE * len(x.text):
            labels.append(None if short or inner else False)
        elif short:
            labels.append(None)
        elif share >= STOP_HIGH or not known:
            labels.append(True)
        else:
            labels.append(None if inner or share >= STOP_LOW else False)
    return labels


def extract(page: str | None) -> str:
    """The main text of a page, its blocks joined by line feeds; "" if there is none."""
    found = list(blocks(page or ""))
    size = [0, 0]
    for x in found:
        size[x.article] += 0 if x.aside else len(x.text) - min(x.linked, len(x.text))
    has_article = size[1] > 0 and size[1] >= ARTICLE_SHARE * size[0]  # a teaser is not the page's article
    labels = _first_pass(found, has_article)
    # an article's blocks hear only each other, and asides speak for nobody
    ahead: list[bool | None] = [None] * len(found)
    near: dict[bool, bool | None] = {False: None, True: None}
    for i in range(len(found) - 1, -1, -1):
        x = found[i]
        ahead[i] = near[has_article and x.article]
        if labels[i] is not None and not x.aside:
            near[has_article and x.article] = labels[i]
    near = {False: None, True: None}
    any_good = any(labels)
    out = []
    for i, x in enumerate(found):
        inner = has_article and x.article
        label, before = labels[i], near[inner]
        if label is None:
            if before is None and ahead[i] is None:
                label = inner or not any_good and x.linked <= LINK_SHARE * len(x.text)
            elif before is None or ahead[i] is None or before == ahead[i]:
                label = ahead[i] if before is None else before
            else:
                label = inner
        elif not x.aside:
            near[inner] = label
        if label:
            out.append(x.text)
    return "\n".join(out)


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_columns
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            texts = pa.array([extract(x.as_py()) for x in part.column(n - 1)], pa.string())
            yield pa.record_batch([*part.columns[: n - 1], texts], names=[*part.schema.names[: n - 1], "main_text"])


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """All rows and columns of ``pages`` and main_text (string, never null).

    Null and empty pages give "". Pages are judged one by one: repeated rows get the same text, very long ones are taken
    whole. A column named main_text is replaced. An empty table gives an empty table.
    """
    pages = pages.drop("main_text")
    schema = StructType([*pages.schema.fields, *StructType.fromDDL("main_text string").fields])
    return in_batches(pages.select("*", F.col(html).alias(unused(pages.columns, "_html")[0])), _extract_batches, schema)
