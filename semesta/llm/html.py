"""Main text of web pages by template deduction from equivalence classes of tokens.

A page is read as structure tokens (an element's path of tags and classes, at its start and end) and text
tokens (a block's text with its path). A token's occurrence vector says how often it occurs on each
page of its host; it is kept as the exclusive or of a hash of every page and count, so vectors combine in any
order and a host's pages never meet in one task. Tokens of equal vectors are an equivalence class. Classes
of two tokens or more that occur on at least ``SUPPORT`` of a host's pages, and on ``LEAST`` pages, are valid.
Paths nest them: a class lies in the slot that the elements above it leave. Together they are the host's
template: its structure tokens are the frame, its text tokens what all pages repeat.

What remains in the slots is extracted, where the frame around it is not navigation, a page header, a
footer, a sidebar, a notice, an advert, a form or reader comments, by the element's name or a whole name in
its class, id or role. Names that parts of an article also have drop nothing inside it; a form around text
and a frame around the page's article are wrappers. Where the page has an article (or main, or a content element), only its slots are
extracted. Text there is the template's if it is in one class with that element, so it stands in each one of
the host alike; copies on some pages are not, nor is text of a host whose content elements hold nothing else.

Null html, and pages without such text, have the empty text. A page without host belongs to the host
"". Hosts below ``LEAST`` pages have no template, only roles. Repeated rows stay. Unclosed elements and
comments end with the page. An empty table gives an empty one; columns but the three named aren't read.
"""

from __future__ import annotations

import html as references
import re
import urllib.parse
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semesta.llm.common import small_batches, stored

#: Share of a host's pages, and pages, that a valid class occurs on.
SUPPORT, LEAST = 0.5, 3
#: Tokens that stand for the page itself, and for the texts inside its content elements.
PAGE, INSIDE = 0, 1
#: Entries after which a counting task hands on what it has.
HELD = 200_000

# Names of elements and words of class names, by what they hold.
DROPPED = frozenset("nav footer aside form button select textarea menu dialog".split())
CONTENT = frozenset("article main".split())
CONTENT_WORDS = frozenset("article content post entry story main".split())
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner cookie cookies"
    " consent notice notices alert nav navbar navigation menu menus breadcrumb breadcrumbs footer header masthead sidebar"
    " aside widget widgets comment comments reply replies discussion disqus share sharing social related recommended"
    " newsletter subscribe subscription signup login popup modal overlay form search pagination pager toolbar legal".split()
)
#: Those that also name parts of an article; inside one they drop nothing, but the host's template may.
PARTS = frozenset("notice notices alert header footer replies reply discussion related form search legal banner overlay".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q ruby rt rp s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
#: Names by which a piece of a line is an advert.
ADVERT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end an open one of the same group when they begin, and where the search for it ends.
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_BOUND = frozenset("ul ol dl table body article section div nav".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*+>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)>",
    re.S | re.I,
)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+|[0-9]+")
_TEXT_ELEMENT = re.compile(r"<(?:article|main|p|h[1-3])\b", re.I)
_FORM_END = re.compile(r"</form\b", re.I)


def host_of(url: str | None) -> str:
    try:
        return (urllib.parse.urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


@dataclass
class Block:
    """A run of text with its path, whether its frame drops it, and whether it lies in a content element.

    A path is one number, hashed from the path above and the element's names, however deep the element lies.
    """

    path: int
    text: str
    dropped: bool
    #: Path of the outermost content element that it lies in, or 0; whether a frame in there drops it.
    root: int
    inner: bool


@dataclass
class _Open:
    name: str
    path: int
    dropped: bool
    root: int
    inner: bool


def _below(path: int, label: str) -> int:
    return xxhash.xxh64_intdigest(label.encode("utf-8", "surrogatepass"), path)


def _is_frame(names: str, inside: bool) -> bool:
    """Whether a whole name of class, id or role is that of a frame, or is put together from such words only."""
    return any(
        (words := _WORD.findall(one)) and DROPPED_WORDS.issuperset(words) and not (inside and PARTS.issuperset(words))
        for one in names.split()
    )


def _is_content(names: str) -> bool:
    words = [_WORD.findall(one) for one in names.split()]
    return any(not CONTENT_WORDS.isdisjoint(one) and DROPPED_WORDS.isdisjoint(one) for one in words)


def _names(rest: str) -> str:
    found = _NAMED.findall(rest) if rest else ()
    return " ".join(a or b or c for a, b, c in found).lower()


def _is_advert(names: str) -> bool:
    """Whether a whole name of class, id or role is put together from words for adverts only."""
    return any((words := _WORD.findall(one)) and ADVERT_WORDS.issuperset(words) for one in names.split())


def _opened(name: str, rest: str, above: _Open, wraps: bool) -> _Open:
    """``wraps``: a form around text, which is no frame."""
    names = _names(rest)
    label = f"{name}.{names}" if names or (rest and _NAMED.search(rest)) else name
    path = _below(above.path, label)
    if name in CONTENT:
        return _Open(name, path, above.dropped, above.root or path, above.inner)
    if name in ("html", "body"):
        return _Open(name, path, above.dropped, above.root, above.inner)
    inside = bool(above.root)
    frame = (name in DROPPED and not wraps) or (name == "header" and not inside) or _is_frame(names, inside)
    root = above.root or (path if not frame and _is_content(names) else 0)
    return _Open(name, path, above.dropped or frame, root, above.inner or (inside and frame))


class _Next:
    """The first match of a pattern from a place on, for places that only grow: the page is searched once."""

    def __init__(self, pattern: re.Pattern, page: str):
        self._search, self._page = pattern.search, page
        self._at = -1

    def from_(self, place: int) -> int:
        if self._at < place:
            match = self._search(self._page, place)
            self._at = match.start() if match else len(self._page)
        return self._at


def read(page: str) -> tuple[list[Block], list[int]]:
    """(blocks of text in page order, structure tokens in page order), in time and memory of the page's length."""
    stack = [_Open("", 0, False, 0, False)]
    open_names: Counter[str] = Counter()
    blocks: list[Block] = []
    structure: list[int] = []
    held: list[str] = []
    form_end, text_element = _Next(_FORM_END, page), _Next(_TEXT_ELEMENT, page)
    advert: list | None = None
    at = 0

    def flush() -> None:
        if held:
            text = " ".join(references.unescape("".join(held)).split())
            held.clear()
            if text:
                top = stack[-1]
                blocks.append(Block(top.path, text, top.dropped, top.root, top.inner))

    def close(place: int) -> None:
        flush()
        for one in stack[:place - 1 : -1]:
            structure.append(_below(one.path, "/"))
            open_names[one.name] -= 1
        del stack[place:]

    for tag in _TAG.finditer(page):
        begin, end = tag.span()
        if begin > at:
            held.append(page[at:begin])
        at = end
        name = tag["name"] or tag["name2"]
        if not name:
            continue
        name = name.lower()
        if name in INLINE:
            # A piece of a line that is an advert: what its element holds is taken back at its end.
            if advert is not None and name == advert[0]:
                advert[1] += -1 if tag["end"] or tag["end2"] else 1
                if advert[1] == 0:
                    del held[advert[2] :]
                    held.append(" ")
                    advert = None
            elif advert is None and not (tag["end"] or tag["end2"]) and name not in VOID:
                if (rest := tag["rest"] or tag["rest2"]) and _is_advert(_names(rest)):
                    advert = [name, 1, len(held)]
            continue
        if name == "br":
            held.append(" ")
            continue
        # An element that begins or ends a block ends a line, and no advert goes on behind it.
        flush()
        advert = None
        if tag["end"] or tag["end2"]:
            if open_names[name] > 0:
                place = len(stack) - 1
                while stack[place].name != name:
                    place -= 1
                close(place)
            continue
        if stack[-1].name == "p":
            close(len(stack) - 1)
        if name in _SAME and any(open_names[same] > 0 for same in _SAME[name]):
            for place in range(len(stack) - 1, 0, -1):
                if stack[place].name in _SAME[name]:
                    close(place)
                    break
                if stack[place].name in _BOUND:
                    break
        # A form around text is no frame.
        wraps = name == "form" and text_element.from_(end) < form_end.from_(end)
        opened = _opened(name, tag["rest"] or tag["rest2"] or "", stack[-1], wraps)
        structure.append(opened.path)
        if name not in VOID:
            stack.append(opened)
            open_names[name] += 1
    if at < len(page):
        held.append(page[at:])
    flush()
    return blocks, structure


def _token(kind: str, path: int, text: str = "") -> int:
    return xxhash.xxh64_intdigest(f"{kind}\0{path}\0{text}".encode("utf-8", "surrogatepass")) - (1 << 63)


def _candidates(blocks: list[Block]) -> list[Block]:
    """Blocks that may be main text: those of content elements, or all where there are none.

    A content element inside a frame counts where none stands outside and it holds more than what does.
    """
    free = [block for block in blocks if not block.dropped]
    if any(block.root for block in free):
        return [block for block in free if block.root]
    framed = [block for block in blocks if block.root and not block.inner]
    return framed if sum(len(x.text) for x in framed) > sum(len(x.text) for x in free) else free


def main_text(page: str | None, template: set[int]) -> str:
    """Text of the slots that the host's template leaves; see the module's text."""
    if not page:
        return ""
    blocks = _candidates(read(page)[0])
    return "\n\n".join(block.text for block in blocks if _token("text", block.path, block.text) not in template)


def occurrences(pages: DataFrame) -> DataFrame:
    """(host, token, root, text, vector, pages, total): each token of each host with its occurrence vector.

    ``root`` is the token of the content element that a text lies in, or PAGE.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int, int, bool], list[int]] = {}

        def drain() -> pa.RecordBatch:
            columns = [
                pa.array([k[0] for k in seen], pa.string()),
                pa.array([k[1] for k in seen], pa.int64()),
                pa.array([k[2] for k in seen], pa.int64()),
                pa.array([k[3] for k in seen], pa.bool_()),
                *(pa.array([v[i] for v in seen.values()], pa.int64()) for i in range(3)),
            ]
            seen.clear()
            return pa.RecordBatch.from_arrays(columns, ["host", "token", "root", "text", "vector", "pages", "total"])

        for batch in batches:
            for url, value in zip(batch.column(0), batch.column(1), strict=True):
                page, address = value.as_py() or "", url.as_py() or ""
                host, counts = host_of(address), {}
                blocks, structure = read(page)
                for path in structure:
                    counts[_token("tag", path), PAGE, False] = counts.get((_token("tag", path), PAGE, False), 0) + 1
                for block in {id(x): x for x in [*_candidates(blocks), *(x for x in blocks if not x.dropped)]}.values():
                    root = _token("tag", block.root) if block.root else PAGE
                    key = (_token("text", block.path, block.text), root, True)
                    counts[key] = counts.get(key, 0) + 1
                    if block.root:
                        counts[INSIDE, PAGE, False] = counts.get((INSIDE, PAGE, False), 0) + 1
                # One more token stands for the page itself.
                counts[PAGE, PAGE, False] = 1
                page_hash = xxhash.xxh64_intdigest(f"{address}\0{page}".encode("utf-8", "surrogatepass"))
                for (token, root, text), n in counts.items():
                    vector = xxhash.xxh64_intdigest(page_hash.to_bytes(8, "little"), n) - (1 << 63)
                    entry = seen.get((host, token, root, text))
                    if entry is None:
                        seen[host, token, root, text] = [vector, 1, n]
                    else:
                        entry[0] ^= vector
                        entry[1] += 1
                        entry[2] += n
                if len(seen) > HELD:
                    yield drain()
        yield drain()

    schema = "host string, token bigint, root bigint, text boolean, vector bigint, pages bigint, total bigint"
    small_batches(pages.sparkSession)
    parts = pages.select("url", "html").mapInArrow(run, schema)
    return parts.groupBy("host", "token", "root", "text").agg(
        F.bit_xor("vector").alias("vector"), F.sum("pages").alias("pages"), F.sum("total").alias("total")
    )


def templates(pages: DataFrame) -> DataFrame:
    """(host, classes, frame, repeated): valid classes and their structure and text tokens, for each host that has any."""
    tokens = stored(occurrences(pages).filter(F.col("pages") >= LEAST), "tokens")
    plain = tokens.filter(~F.col("text"))
    hosts = plain.filter(F.col("token") == PAGE).select("host", F.col("pages").alias("of"))
    inside = plain.filter(F.col("token") == INSIDE).select("host", F.col("total").alias("inside"))
    frequent = (
        tokens.filter(~F.col("token").isin(PAGE, INSIDE))
        .join(hosts, "host")
        .filter(F.col("pages") >= SUPPORT * F.col("of"))
    )
    # Text of a content element is the template's if it is in one class with that element.
    roots = frequent.filter(~F.col("text")).select("host", F.col("token").alias("root"), "vector", "pages", "total")
    outside = frequent.filter(F.col("root") == PAGE)
    within = frequent.filter(F.col("root") != PAGE).join(roots, ["host", "root", "vector", "pages", "total"], "left_semi")
    # Where it is all that the host's content elements hold, there is no slot: they are copies.
    slots = within.groupBy("host").agg(F.sum("total").alias("fixed")).join(inside, "host")
    within = within.join(slots.filter(F.col("fixed") < F.col("inside")).select("host"), "host", "left_semi")
    classes = outside.unionByName(within).groupBy("host", "vector", "pages", "total").agg(
        F.count(F.lit(1)).alias("size"), F.collect_list(F.struct("token", "text")).alias("tokens")
    )
    # A text that all pages share is as good as a class: its element's tokens may repeat for other texts.
    valid = classes.filter((F.col("size") > 1) | F.exists("tokens", lambda t: t["text"]))
    each = F.flatten(F.collect_list("tokens"))
    return (
        valid.groupBy("host")
        .agg(F.count(F.lit(1)).alias("classes"), each.alias("tokens"))
        .select(
            "host",
            "classes",
            F.transform(F.filter("tokens", lambda t: ~t["text"]), lambda t: t["token"]).alias("frame"),
            F.transform(F.filter("tokens", lambda t: t["text"]), lambda t: t["token"]).alias("repeated"),
        )
    )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of (page_id, url, html)."""
    repeated = stored(templates(pages).filter(F.size("repeated") > 0).select("host", "repeated"), "templates")

    def with_host(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = pa.array([host_of(url) for url in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([hosts, *batch.columns], ["host", "page_id", "url", "html"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(page.as_py(), set(tokens.as_py() or ()))
                for page, tokens in zip(batch.column(2), batch.column(3), strict=True)
            ]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])

    rows = pages.select("page_id", "url", "html")
    kind = rows.schema["page_id"].dataType.simpleString()
    named = rows.mapInArrow(with_host, f"host string, page_id {kind}, url string, html string")
    joined = named.join(repeated, "host", "left").select("page_id", "url", "html", "repeated")
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string")
