"""Main text of web pages by tag-path ratios.

Every text node has a path of all tags from the root to it.  Per path the text lengths and the punctuation marks of its
nodes are summed and divided by the number of nodes; both ratios are smoothed along the page and fused, and paths whose
fused ratio reaches a share of the page's spread are content.  A block of text is content if a node of it has such a
path.  What stands beside content in the same element (headings, short paragraphs, lists, tables) belongs to it; other
paths don't.  Markup that says what it is (menus, headers, footers, sidebars, forms, adverts, notices, comments,
scripts, hidden parts) is left out; names that only hint at it halve the text ratios of what is in there.

Defined results: a null or empty page, or one without text, gives the empty text; pages of any depth and length are read
whole; unclosed or wrongly nested tags close where HTML closes them; equal pages give equal texts; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)>|<[!?/][^>]*+>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>|\Z", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "template")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
_SPLITS = _BLOCK - {"body", "html", "head"}
_CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th")}
_SCOPE = frozenset("html body table ul ol dl menu div section article main aside form blockquote td th".split())
#: Elements that are never part of an article; those that a class or id doesn't make so.
_OTHER = frozenset("nav header footer aside form button select option datalist menu dialog object svg canvas audio video head search fieldset label input".split())
_FRAME = frozenset("html body article main".split())
#: Words of class and id.  A name that consists of them says what an element is; one that only has some hints at it.
_CUES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promos promotion banner nav navbar navigation menu header masthead footer sidebar aside"
    " widget widgets cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup signin login share sharing social related"
    " recommended comment comments commentlist list box container wrapper section reply replies respond disqus discussion breadcrumb breadcrumbs pagination pager toolbar topbar skip copyright disclaimer".split()
)
#: Of these a name says nothing alone.
_PLAIN = frozenset("list box container wrapper section".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Blocks of text, which a name alone doesn't make something else; parts of lists and tables.
_TEXTS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre td th dd dt figcaption".split())
_PARTS = frozenset("li ul ol dl dt dd table caption tbody thead tfoot tr td th blockquote pre figure figcaption p h1 h2 h3 h4 h5 h6 hgroup center address details summary".split())
_LISTED = frozenset("li dt dd td th".split())
_MARKS = re.compile(r"[.,;:!?\u2026\u3002\uff0c\u3001\uff1b\uff1a\uff01\uff1f]")
#: Share of the fused ratios' standard deviation that a content path reaches; weight of what a name hints to be other.
SPREAD, HINTED = 0.9, 0.5


class _Element:
    """path: number of the tag path; block: the nearest block element; home: the nearest one that isn't a part of text."""

    __slots__ = ("tag", "parent", "other", "hinted", "path", "block", "home")

    def __init__(self, tag, parent, other, hinted, paths):
        self.tag, self.parent = tag, parent
        self.other = other or parent is not None and parent.other
        self.hinted = hinted or parent is not None and parent.hinted
        self.path = paths.setdefault((parent.path if parent is not None else -1, tag, self.hinted), len(paths))
        self.block = self if parent is None or tag in _BLOCK else parent.block
        self.home = self if parent is None or tag in _BLOCK and tag not in _PARTS else parent.home


def _said(tag: str, rest: str) -> tuple[bool, bool]:
    """(is something other than an article, hints at it)."""
    if tag in _OTHER:
        return True, False
    if not rest or rest.isspace() or tag in ("html", "body"):
        return False, False
    says = hints = False
    for name, a, b, c in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            for token in value.split():
                words = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", token).lower())
                cues = [w for w in words if w in _CUES]
                if not all(w in _PLAIN for w in cues):
                    says |= len(cues) == len(words)
                    hints = True
        elif name == "hidden" or name == "role" and value.lower() in _ROLES or name == "aria-hidden" and value.lower() == "true":
            return True, False
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, False
    if tag in _FRAME:
        return False, False
    return (False, True) if tag in _TEXTS and says else (says, hints)


class _Block:
    """nodes: (path, hinted, text length, marks) of each text node."""

    __slots__ = ("element", "text", "nodes")

    def __init__(self, element, text, nodes):
        self.element, self.text, self.nodes = element, text, nodes


def blocks(page: str) -> list[_Block]:
    """Text blocks of a page in order, with the element that each stands in and its text nodes."""
    paths: dict[tuple, int] = {}
    stack, out, held, nodes = [_Element("#", None, False, False, paths)], [], [], []
    own = stack[0]
    paragraphs = 0

    def flush():
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append(_Block(own, text, tuple(nodes)))
            held.clear()
            nodes.clear()

    def close(i):
        nonlocal paragraphs
        if any(e.tag in _SPLITS for e in stack[i:]):
            flush()
        paragraphs -= sum(e.tag == "p" for e in stack[i:])
        del stack[i:]

    def say(raw):
        nonlocal own
        at = stack[-1]
        if raw and not at.other:
            if held and own is not at.block:
                flush()
            own = at.block
            text = html.unescape(raw) if "&" in raw else raw
            held.append(text)
            size = len(" ".join(text.split()))
            if size:
                nodes.append((at.path, at.hinted, size, len(_MARKS.findall(text))))

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                say(html.escape(m[0][9:-3]))
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag not in _BLOCK and stack[i].tag in _BLOCK:
                    break
            continue
        if tag in _RAW:
            at = _RAW[tag].search(page, at).end()
            continue
        if tag in _SPLITS:
            flush()
            for i in range(len(stack) - 1, 0, -1) if paragraphs else ():  # an open paragraph ends here
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in _SCOPE:
                    break
        if tag in _CLOSED_BY:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in _CLOSED_BY[tag]:
                    close(i)
                    break
                if stack[i].tag in _SCOPE - {"td", "th"}:
                    break
        if tag == "br":
            say(" ")
        rest = m["rest"] or m["rest2"] or ""
        if tag in _VOID or rest.endswith("/") and tag not in _BLOCK:
            continue
        paragraphs += tag == "p"
        stack.append(_Element(tag, stack[-1], *_said(tag, rest), paths))
    flush()
    return out


def _smooth(x: np.ndarray) -> np.ndarray:
    weights = np.exp(-0.5 * np.arange(-2, 3) ** 2)
    padded = np.pad(x, 2)
    ones = np.pad(np.ones(len(x)), 2)
    return np.convolve(padded, weights, "valid") / np.convolve(ones, weights, "valid")


def content_paths(found: list[_Block], spread: float = SPREAD) -> set[int]:
    """Paths whose fused ratio stands out."""
    nodes = [x for b in found for x in b.nodes]
    path, hinted, length, marks = (np.array(c) for c in zip(*nodes))
    _, of, count = np.unique(path, return_inverse=True, return_counts=True)
    weight = np.where(hinted, HINTED, 1.0)
    text = _smooth((np.bincount(of, length) / count)[of] * weight)
    punctuation = _smooth((np.bincount(of, marks) / count)[of])
    fused = text * (1 + punctuation)
    ratio = np.bincount(of, fused) / count
    return set(path[(ratio >= min(spread * fused.std(), ratio.max()))[of]].tolist())


def main_text(page: str | None, spread: float = SPREAD) -> str:
    found = [b for b in blocks(page) if b.nodes] if page else []
    if not found:
        return ""
    paths = content_paths(found, spread)
    sure = [any(x[0] in paths for x in b.nodes) for b in found]
    homes = set()
    for b, ok in zip(found, sure):
        e = b.element.home if ok else None
        while e is not None and e not in homes:
            homes.add(e)
            e = e.parent
    first = sure.index(True)
    out = []
    for i, (b, ok) in enumerate(zip(found, sure)):
        beside = b.element.tag in _PARTS and not b.element.hinted and b.element.home in homes
        if ok or beside and (i > first or b.element.tag not in _LISTED):
            out.append(b.text)
    return "\n\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(parts):
        for part in parts:
            texts = [main_text(h) for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema=schema)

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages"))
