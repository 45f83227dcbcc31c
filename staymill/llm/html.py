"""Main text of web pages by two passes of rules over blocks.

A page is cut into blocks at its block-level tags. The first pass decides blocks by what they are: their share of stop
words, their length, their share of linked text, and the container they stand in. Blocks too short or too poor in stop
words for a decision stay open. In the second pass these take the label of their nearest decided neighbours, first inside
their own container, then over the page.

Scale: a map over pages, nothing is shuffled or broadcast; reading a page takes time in proportion to its length, also
where tags, quotes or comments are never closed.

Defined cases: null or empty html, and pages without any kept block, give the text ''. Rows with equal ids are separate;
ids and urls may be null; other columns are not read. References that cannot be decoded stay as they are."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymill.llm.words import chunks

# --- Fixed values: tags, attribute words and stop words ------------------------
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style title textarea iframe noembed noframes xmp".split())  # their content is not markup
UNSEEN_TAGS = frozenset("head noscript template object svg math canvas audio video select datalist button".split())
SIDE_TAGS = frozenset("nav footer aside form menu dialog".split())  # never part of an article
MAIN_TAGS = frozenset("article main".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup login "
    "comment comments disqus respond share sharing social related recommended widget pagination pager toolbar masthead".split()
)
STOP_WORDS = frozenset(
    "the of and to a in is that it for on was with as be by at are this from or an have not but had his they which you were "
    "le la les de des du et un une est en que qui dans pour pas sur au avec ce il elle par plus se sont "
    "der die das und ist nicht ein eine mit von zu den dem auf für im sich auch es an als bei nach wird "
    "el los las y es una por con para no su lo como más pero sus al del se o".split()
)
SHORT = 70  # characters below which a block alone decides nothing
LONG = 200  # characters from which a moderate share of stop words is enough
STOP_SHARE_HIGH, STOP_SHARE_LOW = 0.20, 0.10
LINK_SHARE = 0.33
# ------------------------------------------------------------------------------

_TAG = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|!--|[!?])")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_EDGE = re.compile("[\"'>]")
_WORD = re.compile(r"[^\W\d_]+")
_SIDE, _HEADER, _MAIN, _PLAIN, _UNSEEN = range(5)


class Block:
    __slots__ = ("text", "linked", "kind", "region")

    def __init__(self, text: str, linked: int, kind: int, region: int):
        self.text, self.linked, self.kind, self.region = text, linked, kind, region


def _tag_end(html: str, at: int) -> int:
    """Place after the `>` that ends a tag; quoted values may hold `>`. An open quote or tag ends at the next `>` or the end."""
    start = at
    while edge := _EDGE.search(html, at):
        at = edge.end()
        if edge[0] == ">":
            return at
        before = edge.start() - 1
        while before >= start and html[before].isspace():
            before -= 1
        if before < start or html[before] != "=":  # a stray quote, no value
            continue
        end = html.find(edge[0], at)
        if end < 0:
            close = html.find(">", start)
            return close + 1 if close >= 0 else len(html)
        at = end + 1
    return len(html)


def _kind(name: str, attributes: str, inside: int) -> int:
    """What an element makes of the blocks in it, given what it stands in itself."""
    if inside in (_UNSEEN, _SIDE):
        return inside
    if name in UNSEEN_TAGS:
        return _UNSEEN
    if name in SIDE_TAGS:
        return _SIDE
    kind = _MAIN if name in MAIN_TAGS else inside
    if name == "header" and inside != _MAIN:
        kind = _SIDE
    if "=" in attributes or "hidden" in attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key == "hidden" or key == "aria-hidden" and value == "true":
                return _UNSEEN
            if key == "role" and value in SIDE_ROLES:
                return _SIDE
            if key == "role" and value in MAIN_TAGS:
                kind = _MAIN
            if key in ("class", "id") and name not in ("html", "body", *MAIN_TAGS):
                words = set(_WORD.findall(value))
                if words & SIDE_WORDS or "header" in words and inside != _MAIN:
                    return _SIDE
    return kind


def blocks(html: str) -> list[Block]:
    """The blocks of a page in order, with white space run together and references decoded."""
    out: list[Block] = []
    open_: list[tuple[str, int, int]] = [("", _PLAIN, 0)]  # (tag, kind, region)
    depth: dict[str, int] = {}
    text: list[tuple[str, bool]] = []
    links = regions = 0
    unclosed: set[str] = set()  # raw tags that have no end tag any more

    def flush() -> None:
        if text:
            whole = " ".join(unescape("".join(t for t, _ in text)).split())
            if whole:
                linked = " ".join(unescape("".join(t if a else " " for t, a in text)).split())
                out.append(Block(whole, len(linked), open_[-1][1], open_[-1][2]))
            text.clear()

    at = 0
    while at < len(html):
        m = _TAG.search(html, at)
        stop = m.start() if m else len(html)
        if stop > at and open_[-1][1] != _UNSEEN:
            text.append((html[at:stop], links > 0))
        if not m:
            break
        if m[2] is None:
            if m[0] == "<!--":
                end = html.find("-->", m.end() - 2 if html.startswith(">", m.end()) else m.end())
                at = end + 3 if end >= 0 else len(html)
            else:
                at = _tag_end(html, m.end())
            continue
        name = m[2].lower()
        at = _tag_end(html, m.end())
        if m[1]:  # an end tag
            if name == "a":
                links = 0
            if name in BLOCK_TAGS:
                flush()
                links = 0
            if depth.get(name):
                while True:
                    last = open_.pop()[0]
                    depth[last] -= 1
                    if last == name:
                        break
            continue
        if name == "br":
            text.append((" ", False))
            continue
        if name in RAW_TAGS:
            end = None if name in unclosed else re.compile(f"</{name}", re.I).search(html, at)
            if end:
                at = _tag_end(html, end.end())
            else:
                unclosed.add(name)
                at = len(html)
            continue
        if name == "a":
            links = 1
        if name in BLOCK_TAGS:
            flush()
        if name == "body" and depth.get("head"):  # an open head ends here
            while open_[-1][0] != "head":
                depth[open_.pop()[0]] -= 1
            depth[open_.pop()[0]] -= 1
        if name in VOID_TAGS or name in ("p", "li", "a") or html[at - 2 : at] == "/>":
            if name != "a" and name not in VOID_TAGS:
                attributes = html[m.end() : at]
                if "=" in attributes and _kind(name, attributes, open_[-1][1]) not in (open_[-1][1], _MAIN):
                    open_.append((name, _kind(name, attributes, open_[-1][1]), regions := regions + 1))
                    depth[name] = depth.get(name, 0) + 1
            continue
        inside = open_[-1][1]
        kind = _kind(name, html[m.end() : at], inside)
        if kind != inside or name in MAIN_TAGS:
            regions += 1
            flush()
            open_.append((name, kind, regions))
        else:
            open_.append((name, kind, open_[-1][2]))
        depth[name] = depth.get(name, 0) + 1
    flush()
    return out


def _first_pass(block: Block, stop_words: frozenset[str]) -> bool | None:
    """True and False are decided, None is open."""
    if block.kind == _SIDE:
        return False
    size = len(block.text)
    if block.linked > LINK_SHARE * size and (block.kind != _MAIN or block.linked > 0.8 * size and size >= SHORT):
        return False
    if size < SHORT:
        return None
    words = [w.lower() for w in _WORD.findall(block.text)]
    share = sum(w in stop_words for w in words) / max(len(words), 1)
    if share >= STOP_SHARE_HIGH or share >= STOP_SHARE_LOW and size >= LONG:
        return True
    return None


def _second_pass(page: list[Block], labels: list[bool | None]) -> list[bool]:
    """Open blocks take the label of the nearest decided neighbour of their region, else of the page; a tie is kept only
    between two kept ones. A region that is an article, and has nothing decided, is kept as a whole."""
    out: list[bool] = []
    n = len(page)
    for same_region in (True, False):
        before: list[tuple[int, bool] | None] = [None] * n
        after: list[tuple[int, bool] | None] = [None] * n
        for order, near in ((range(n), before), (range(n - 1, -1, -1), after)):
            last: dict[int, tuple[int, bool]] = {}
            for i in order:
                key = page[i].region if same_region else 0
                near[i] = last.get(key)
                if labels[i] is not None:
                    last[key] = (i, labels[i])
        out = []
        for i, label in enumerate(labels):
            if label is None:
                a, b = before[i], after[i]
                if a and b:
                    left, right = i - a[0], b[0] - i
                    label = a[1] and b[1] if left == right else a[1] if left < right else b[1]
                elif a or b:
                    label = (a or b)[1]
                elif same_region:
                    label = True if page[i].kind == _MAIN else None
                else:
                    label = False
            out.append(label)
        labels = out
    return out


def main_text(html: str | None, stop_words: frozenset[str] = STOP_WORDS) -> str:
    if not html:
        return ""
    page = blocks(html)
    labels = _second_pass(page, [_first_pass(b, stop_words) for b in page])
    return "\n".join(b.text for b, kept in zip(page, labels) if kept)


def _extract(batches: Iterator[pa.RecordBatch], stop_words: frozenset[str]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, "html"):
        texts = [main_text(h, stop_words) for h in chunk.column("html").to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "page_id": chunk.column("page_id"), "url": chunk.column("url"), "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        })


def extract(pages: DataFrame, stop_words: frozenset[str] = STOP_WORDS) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of `pages` (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(lambda it: _extract(it, stop_words), "page_id long, url string, text string, n_chars long")
