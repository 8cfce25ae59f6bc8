"""Main text of web pages by site template removal.

1. Each page is parsed once (a tag scanner and an open-element stack). Every
   element subtree gets a hash of its tag, class and content; every text block
   keeps the hashes of the elements around it.
2. Spark counts, per host, on how many different pages each hash occurs. Pages
   that carry the same main content count once, so an article published under
   several addresses is not taken for a template. A subtree recurring on at
   least ``min_pages`` pages is a template, however large the host.
3. Blocks inside a template are deleted. What templates cannot show (a menu or
   a reader comment that only one page has) goes by the element's role: tag,
   class, id or role words. Nothing else is dropped: text beside a marked
   article stays.

Paragraph-like elements inside the marked article, and others there that hold
text themselves, are text, not templates: articles may quote the same line on
many pages. A class or id names chrome only as a whole (``ad-slot``, not
``ad-hoc``); a form that holds the article is none. Parsing is linear in the page.

Hashes and counts are the only rows shuffled by host, pre-aggregated in the map
tasks; the hashes are a work table, so the count and its use read the same rows.

Cases: null or empty html gives an empty text; null urls and urls without a
host share one host; malformed markup is read leniently (unknown, unclosed and
stray tags, a bare ``<`` is text); repeated rows each get their result;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, with_package, written

#: A tag whose quoted attribute values are skipped, and one that ends at the next ">".
QUOTED = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>", re.S)
PLAIN = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>", re.S)
COMMENT = re.compile(r"<!--(?:.*?-->|.*\Z)|<[!?/][^>]*>", re.S)
ATTRIBUTE = re.compile(r"(?<![^\s=/\"'>])([^\s=/\"'>]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.S)
STORY = re.compile(r"<(?:article|main)\b", re.I)
FORM_END = re.compile(r"</form\b", re.I)
WORDS = re.compile(r"[A-Za-z]+")

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements whose start closes an open element of the set, unless a barrier lies between.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
BARRIER = frozenset("ul ol dl table select body html article section div main".split())
#: What ends a search among the open elements: (these tags, beside the barriers).
NEAREST = {"p": ({"p"}, BARRIER | {"button", "td", "th"}), "li": ({"li"}, BARRIER), "dt": ({"dt", "dd"}, BARRIER),
           "tr": ({"tr", "td", "th"}, BARRIER), "option": ({"option"}, BARRIER)}
GROUP = {"li": "li", "dt": "dt", "dd": "dt", "tr": "tr", "td": "tr", "th": "tr", "option": "option"}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
                   "hr main menu nav ol p pre section table ul".split())
CHROME_TAGS = frozenset("nav header footer aside form menu dialog button select script style noscript template iframe "
                        "object svg canvas head title textarea xmp".split())
CHROME_WORDS = frozenset("ad ads advert adverts advertisement banner sponsor sponsored promo cookie cookies consent gdpr "
                         "notice alert popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs "
                         "footer masthead comment comments disqus replies share sharing social related recommended "
                         "newsletter subscribe subscription signup login pagination pager toolbar widget skip".split())
#: Words that say where or what a box is; with one of CHROME_WORDS they name chrome, too.
BOX_WORDS = frozenset("article area bar block body bottom box button buttons card cards col column container content "
                      "count desktop fixed form global group head header icon icons inner item items left link links "
                      "list main mobile more new outer page panel post posts primary reader readers right row secondary "
                      "section site slot small sticky story stories text thread title tools top unit user users wrap "
                      "wrapper".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
#: An article element with such a word is a teaser, not the page's story.
TEASER_WORDS = frozenset("ad ads advert adverts advertisement sponsor sponsored promo related recommended teaser "
                         "teasers".split())
COMMENT_WORDS = frozenset(["comment", "comments"])
#: Text-level elements: inside the marked article they are never templates.
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption dd dt dl td th tr table tbody thead ol ul li "
                      "article main body html".split()) | INLINE


class _Open:
    """An open element: ``index`` of its template candidate (-1: none), ``around``
    of the nearest one at or above it, ``block`` the nearest element that is not
    inline, ``near`` the depths of the nearest open elements of NEAREST's sets."""
    __slots__ = ("tag", "chrome", "inside", "index", "around", "digest", "block", "near", "worded")

    def __init__(self, tag, chrome, inside, index, parent, depth, kind):
        self.tag, self.chrome, self.inside, self.index = tag, chrome, inside, index
        self.around = index if index >= 0 else parent.around if parent else -1
        self.block = parent.block if parent and tag in INLINE else self
        self.near = parent.near if parent else dict.fromkeys(NEAREST, -1)
        if tag in BARRIER or tag in ("button", "p") or tag in GROUP:
            self.near = {k: depth if tag in own else -1 if tag in ends else self.near[k]
                         for k, (own, ends) in NEAREST.items()}
        self.worded = False
        self.digest = [tag + "." + kind]


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(raw)} if "=" in raw else {}


def _names_chrome(at: dict[str, str], words: frozenset[str] = CHROME_WORDS) -> bool:
    """Whether a class or the id names chrome as a whole: it consists of such
    words, alone or with words for boxes and places (``share-buttons`` does,
    ``share-price`` does not)."""
    for token in f"{at.get('class', '')} {at.get('id', '')}".lower().split():
        parts = WORDS.findall(token)
        if not words.isdisjoint(parts) and all(x in CHROME_WORDS or x in BOX_WORDS or x in words for x in parts):
            return True
    return False


def _is_chrome(tag: str, at: dict[str, str], inside: bool) -> bool:
    if tag in CHROME_TAGS and not (tag == "header" and inside):
        return True
    if tag in ("html", "body", "article", "main") and at.get("role", "") not in CHROME_ROLES:
        return inside and _names_chrome(at, COMMENT_WORDS) or tag == "article" and _names_chrome(at, TEASER_WORDS)
    if at.get("role", "").lower() in CHROME_ROLES or "hidden" in at or at.get("aria-hidden") == "true":
        return True
    return _names_chrome(at)


@dataclass
class Parsed:
    """A page's text blocks as (text, place, template candidate around it or -1);
    of every candidate its hash (None: it holds text of an article itself), the
    candidate around it, and whether it lies in or around a marked part; the
    signatures of the marked part (all text, if none) and of all text.
    Place: 2 in an article, 1 in a main part, 0 elsewhere, -1 in chrome."""
    blocks: list[tuple[str, int, int]]
    hashes: list[int | None]
    around: list[int]
    marked: list[bool]
    signatures: tuple[int, int]


class _Tags:
    """Tags and comments in page order, each as (start, end, is an end tag,
    name, attributes); linear in the page, whatever its quotes."""

    def __init__(self, page: str) -> None:
        self.page, self.last, self.quotes = page, page.rfind(">"), True

    def after(self, pos: int):
        page = self.page
        while True:
            at = page.find("<", pos)
            if at < 0:
                return None
            if page.startswith("<!--", at):
                return at, COMMENT.match(page, at).end(), False, "", ""
            if at > self.last:                           # nothing closes any more but a comment
                pos = at + 1
                continue
            head = page[at + 1:at + 2]
            if head.isascii() and head.isalpha() or head == "/" and page[at + 2:at + 3].isascii() and page[at + 2:at + 3].isalpha():
                m = QUOTED.match(page, at) if self.quotes else None
                if m is None:                            # a quote stays open to the end: no later tag looks for one
                    self.quotes = False
                    m = PLAIN.match(page, at)
                return at, m.end(), bool(m[1]), m[2].lower(), m[3]
            if head and head in "!?/":
                return at, COMMENT.match(page, at).end(), False, "", ""
            pos = at + 1


class _Next:
    """Where a pattern is found next, searched once for any rising positions."""

    def __init__(self, pattern: re.Pattern, page: str) -> None:
        self.pattern, self.page, self.at = pattern, page, -1

    def after(self, pos: int) -> int:
        if self.at < pos:
            m = self.pattern.search(self.page, pos)
            self.at = m.start() if m else len(self.page)
        return self.at


def parse(page: str | None) -> Parsed:
    page = page or ""
    stack: list[_Open] = [_Open("", False, 0, -1, None, 0, "")]
    opened: Counter = Counter()
    hashes: list[int | None] = []
    around: list[int] = []
    marked: list[bool] = []
    blocks: list[tuple[str, int, int]] = []
    held: list[str] = []
    own: tuple[int, int] = (0, -1)
    story, form_end = _Next(STORY, page), _Next(FORM_END, page)

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                blocks.append((text, *own))

    def put(raw: str) -> None:
        nonlocal own
        if not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        top = stack[-1]
        if not text.isspace():
            top.block.worded = True
        elif not held:
            return
        if not held:
            own = (-1 if top.chrome else top.inside, top.around)
        held.append(text)
        top.digest.append(" ".join(text.split()))

    def close(to: int) -> None:
        while len(stack) > to:
            o = stack.pop()
            opened[o.tag] -= 1
            if o.tag not in INLINE:
                flush()
            d = xxhash.xxh64_intdigest("\x1f".join(o.digest))
            if o.index >= 0 and not (o.inside and o.worded):
                hashes[o.index] = d
            stack[-1].digest.append(format(d, "x"))

    def open_(tag: str, raw: str) -> None:
        if tag in ENDS_P and stack[-1].near["p"] > 0:
            close(stack[-1].near["p"])
        if tag in CLOSES:
            while (i := stack[-1].near[GROUP[tag]]) > 0 and stack[i].tag in CLOSES[tag]:
                close(i)
                if tag != "tr":
                    break
        if tag not in INLINE:
            flush()
        if tag in VOID:
            return
        at = _attributes(raw)
        top = stack[-1]
        inside = 2 if tag == "article" or top.inside == 2 else 1 if tag == "main" or at.get("role") == "main" else top.inside
        if inside and not top.inside:
            i = top.around
            while i >= 0 and not marked[i]:
                marked[i] = True
                i = around[i]
        index = -1
        if tag not in ("html", "body", "head") and not (tag in PARAGRAPH and (inside or tag in INLINE)):
            index = len(hashes)
            hashes.append(None)
            around.append(top.around)
            marked.append(bool(inside))
        chrome = _is_chrome(tag, at, bool(top.inside))
        if tag == "form" and chrome and story.after(pos) < form_end.after(pos):
            chrome = False                               # the whole page is a form
        stack.append(_Open(tag, top.chrome or chrome, inside, index, top, len(stack), at.get("class", "")))
        opened[tag] += 1

    pos, tags = 0, _Tags(page)
    while found := tags.after(pos):
        start, end, ends, tag, raw = found
        put(page[pos:start])
        pos = end
        if not tag:
            continue
        if ends:
            if opened[tag]:
                i = len(stack) - 1
                while stack[i].tag != tag:
                    i -= 1
                close(i)
            elif tag not in INLINE:
                flush()
            continue
        if tag == "br":
            if held:
                held.append(" ")
            continue
        open_(tag, raw)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>|\Z", re.I).search(page, pos)
            if tag not in ("script", "style"):
                put(page[pos:end.start()])
            pos = end.end()
            close(len(stack) - 1)
    put(page[pos:])
    close(1)
    flush()
    text = [b[0] for b in blocks if b[1] >= 0]
    own_text = [b[0] for b in blocks if b[1] > 0] or text
    return Parsed(blocks, hashes, around, marked,
                  tuple(xxhash.xxh64_intdigest("\x1e".join(t)) for t in (own_text, text)))


#: Compressed bytes of a batch: a few times as much html.
PACKED_BYTES = 4 << 20


@dataclass(frozen=True)
class Params:
    min_pages: int = 5


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _rows(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))


def _key(url: str | None, page: bytes) -> bytes:
    """128 bits of a page's address and markup, on which alone its templates
    depend: the same in every scan, however the input is split."""
    address = (url or "").encode()
    return hashlib.blake2b(len(address).to_bytes(8, "big") + address + page, digest_size=16).digest()


def subtrees(pages: DataFrame) -> DataFrame:
    """``row, key, host, signature, hashes, whole, beside``, one row a page: no
    text. Hashes in or around a marked part count by its signature, those
    beside it by the whole page's. The row number holds for the written table only."""
    def run(batches):
        for whole in batches:
            for b in small_batches(whole, "html"):
                raw = b.column("html").to_pylist()
                keys = [_key(u, (t or "").encode()) for u, t in zip(b.column("url").to_pylist(), raw)]
                got = [parse(t) for t in raw]
                first, beside = ([list(dict.fromkeys(_signed(h) for h, m in zip(g.hashes, g.marked) if m == kind and h is not None))
                                  for g in got] for kind in (True, False))
                signs = [pa.array([_signed(g.signatures[i]) for g in got], pa.int64()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), b.column("url"), signs[0], pa.array(first, pa.list_(pa.int64())),
                     signs[1], pa.array(beside, pa.list_(pa.int64()))],
                    ["key", "url", "signature", "hashes", "whole", "beside"])
    out = with_package(_rows(pages)).mapInArrow(
        run, "key binary, url string, signature long, hashes array<long>, whole long, beside array<long>")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    return out.select(F.monotonically_increasing_id().alias("row"), "key", F.coalesce(host, F.lit("")).alias("host"),
                      "signature", "hashes", "whole", "beside")


def templates(found: DataFrame, p: Params = Params()) -> DataFrame:
    """``host, hash`` of the recurring subtrees."""
    return found.select("host", "signature", F.explode("hashes").alias("hash")).union(
        found.select("host", "whole", F.explode("beside"))).distinct() \
        .groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= p.min_pages).select("host", "hash")


def main_text(page: str | None, template: set[int]) -> tuple[str, int]:
    """The main text, and how many blocks were deleted as template."""
    got = parse(page)
    gone: list[bool] = []                                # by candidate; the one around comes first
    for h, i in zip(got.hashes, got.around):
        gone.append(i >= 0 and gone[i] or h is not None and _signed(h) in template)
    open_ = [b for b in got.blocks if b[1] >= 0]
    kept = [b for b in open_ if b[2] < 0 or not gone[b[2]]]
    return " ".join(b[0] for b in kept), len(open_) - len(kept)


def extract_main(pages: DataFrame, p: Params = Params()) -> DataFrame:
    """``page_id, url, text, n_chars, n_deleted`` (blocks deleted as template).

    ``pages`` is read twice and must give the same rows, in any order and
    partitions. The html meets its page's template hashes by one join on the
    page's key, compressed for the way; it is parsed a second time there, which
    costs less than keeping all parsed blocks."""
    found = written(subtrees(pages), "html-subtrees")
    first = found.groupBy("key").agg(F.min("row").alias("row"))     # repeated pages share their templates
    recurring = found.select("row", "host", F.explode(F.concat("hashes", "beside")).alias("hash")) \
        .join(templates(found, p), ["host", "hash"]).groupBy("row").agg(F.collect_set("hash").alias("template"))   # bounded by its subtrees
    recurring = recurring.join(first, "row").select("key", "template")

    def pack(batches):
        press = zstandard.ZstdCompressor(level=3)
        for whole in batches:
            for b in small_batches(whole, "html"):
                raw = [(t or "").encode() for t in b.column("html").to_pylist()]
                keys = [_key(u, t) for u, t in zip(b.column("url").to_pylist(), raw)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *b.columns[:-1],
                                                  pa.array(map(press.compress, raw), pa.binary())], ["key", *b.schema.names])

    def run(batches):
        press = zstandard.ZstdDecompressor()
        for whole in batches:
            for b in small_batches(whole, "html", PACKED_BYTES):
                got = [main_text(press.decompress(t).decode(), set(h or ()))
                       for t, h in zip(b.column("html").to_pylist(), b.column("template").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column("page_id"), b.column("url"), pa.array([t for t, _ in got], pa.string()),
                     pa.array([len(t) for t, _ in got], pa.int64()), pa.array([n for _, n in got], pa.int32())],
                    ["page_id", "url", "text", "n_chars", "n_deleted"])
    packed = with_package(_rows(pages)).mapInArrow(pack, "key binary, page_id long, url string, html binary")
    return packed.join(recurring, "key", "left").select("page_id", "url", "html", "template").mapInArrow(
        run, "page_id long, url string, text string, n_chars long, n_deleted int")
