"""Extraction from stored HTML pages (``pages(page_id, url, html)``).

Two paths:

* **Built-in fast path** (JVM, whole-stage codegen): links and the first
  heading via ``regexp_extract_all`` / ``regexp_extract`` plus higher-order
  array functions. Use it when the markup is regular.
* **Parser path**: ``mapInArrow`` runs a small stdlib ``html.parser`` tree
  builder per page inside each task (Arrow batches in and out; pages of plain
  markup are read by one regular expression to the same end) and emits the
  whole bronze document: title, address lines, the label/value maps, the
  description and the link list. Spark partitions the pages; nothing is
  collected to the driver.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from typing import Iterator, Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import predicates as P
from ..functions import text as X

# --- built-in fast path -------------------------------------------------------

# What an HTML parser does not see as markup: comments, scripts, styles.
NOT_MARKUP = r"(?is)<!--.*?(?:-->|$)|<(script|style)\b.*?(?:</\1\s*>|$)"
ANCHOR_TAG = r"""(?i)<a\s(?:"[^"]*"|'[^']*'|[^'">])*>"""


def _markup(html) -> Column:
    return F.regexp_replace(X._c(html), NOT_MARKUP, "")


def _attribute(tag: Column, name: str) -> Column:
    """Value of a tag's attribute, quoted or not; "" when absent. Quoted values
    before it are passed over whole, so a name inside one is no attribute."""
    value = F.regexp_extract(tag, r"""(?is)^<\w+(?:[^"'>]*(?:"[^"]*"|'[^']*'))*?[^"'>]*?\s""" + name
                             + r"""\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2")


def unescape_basic(c) -> Column:
    """Decode the basic character references as an HTML parser does in text:
    the trailing ``;`` is optional for these legacy names (``&amp`` -> ``&``).
    ``&amp`` goes last so ``&amp;lt;`` decodes once, to ``&lt;``. Other
    references (``&eacute;``, ``&#233;``) are left to the parser path."""
    x = X._c(c)
    for pat, ch in ((r"&lt;?", "<"), (r"&gt;?", ">"), (r"&quot;?", '"'),
                    (r"&#0*39;?", "'"), (r"&amp;?", "&")):
        x = F.regexp_replace(x, pat, ch)
    return x


def anchor_hrefs(html, cls: str | None = None) -> Column:
    """Array of href values of ``<a>`` tags (optionally only those carrying
    class ``cls``), in document order, duplicates kept, as the parser path
    gives them: any case, values quoted or not, references decoded, nothing
    from comments, scripts or styles."""
    tags = F.regexp_extract_all(_markup(html), F.lit(ANCHOR_TAG), 0)
    if cls:
        tags = F.filter(tags, lambda t: F.array_contains(F.split(_attribute(t, "class"), r"\s+"), cls))
    hrefs = F.transform(tags, lambda t: unescape_basic(_attribute(t, "href")))
    return F.filter(hrefs, lambda h: h != "")


def first_tag_text(html, tag: str, cls: str | None = None) -> Column:
    """Text of the first ``<tag>`` (with class ``cls``), inner tags removed,
    entities decoded, trimmed; "" when absent (parser semantics for
    elements without nested markup)."""
    has = "" if not cls else (r"""(?=[^>]*\sclass\s*=\s*(?:["'](?:[^"'>]*\s)?""" + cls + r"""(?:\s[^"'>]*)?["']|""" + cls + r"""[\s>]))""")
    pat = r"(?is)<" + tag + has + r"(?:\s[^>]*)?>(.*?)</" + tag + r"\s*>"
    inner = F.regexp_extract(_markup(html), pat, 1)
    text = unescape_basic(F.regexp_replace(inner, r"<[^>]*>", ""))
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def page_links(domain: Column, cls: str | None = None, html: str = "html") -> Column:
    """Array of a page's links: hrefs of listing anchors, foreign absolute
    links dropped, relative links made absolute."""
    kept = F.filter(anchor_hrefs(html, cls), lambda h: P.keeps_link(h, domain))
    return F.transform(kept, lambda h: X.absolute_url(h, domain))


def extract_links(pages: DataFrame, domain=None, cls: str | None = None,
                  key: str = "page_id") -> DataFrame:
    """One row per (page, position, link): hrefs of listing anchors, foreign
    absolute links dropped, relative links made absolute. ``domain`` is a
    fixed site prefix or, when None, each page's own origin."""
    dom = F.regexp_extract("url", r"^(https?://[^/?#]+)", 1) if domain is None else F.lit(domain)
    exploded = pages.select(key, dom.alias("_domain"),
                            F.posexplode(anchor_hrefs("html", cls)).alias("pos", "href"))
    return (exploded.filter(P.keeps_link("href", F.col("_domain")))
                    .select(key, "pos", X.absolute_url("href", F.col("_domain")).alias("link")))


# --- parser path ---------------------------------------------------------------

# The listing page's element selectors (tag, class).
@dataclass(frozen=True)
class PageSpec:
    title: tuple = ("h1", "re__pr-title")
    address_1: tuple = ("span", "re__address-line-1")
    address_2: tuple = ("span", "re__address-line-2")
    short_item: tuple = ("div", "re__pr-short-info-item")
    short_label: tuple = ("span", "title")
    short_value: tuple = ("span", "value")
    short_ext: tuple = ("span", "ext")
    spec_item: tuple = ("div", "re__pr-specs-content-item")
    spec_label: tuple = ("span", "re__pr-specs-content-item-title")
    spec_value: tuple = ("span", "re__pr-specs-content-item-value")
    description: tuple = ("div", "re__detail-content")
    link: tuple = ("a", "js__product-link-for-product-id")

    def maps(self) -> dict[str, tuple]:
        """Label/value maps of the document: (item, selectors of its label,
        value and, where there is one, extension)."""
        return {"short_info": (self.short_item, (self.short_label, self.short_value, self.short_ext)),
                "specs": (self.spec_item, (self.spec_label, self.spec_value))}


_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link",
         "meta", "param", "source", "track", "wbr"}
_HIDDEN = {"script", "style", "template"}


class _Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def classes(self):
        return (self.attrs.get("class") or "").split()

    def matches(self, tag, cls):
        return self.tag == tag and (cls is None or cls in self.classes())

    def iter(self):
        stack = list(reversed(self.children))
        while stack:
            n = stack.pop()
            if isinstance(n, _Node):
                yield n
                stack.extend(reversed(n.children))

    def find(self, tag, cls=None) -> Optional["_Node"]:
        return next((n for n in self.iter() if n.matches(tag, cls)), None)

    def find_all(self, tag, cls=None):
        return [n for n in self.iter() if n.matches(tag, cls)]

    def strings(self):
        stack = list(reversed(self.children))
        while stack:
            n = stack.pop()
            if isinstance(n, _Node):
                if n.tag not in _HIDDEN:
                    stack.extend(reversed(n.children))
            else:
                yield n

    def text(self, sep: str = "") -> str:
        return sep.join([t for s in self.strings() if (t := s.strip())])


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, {k: (v or "") for k, v in attrs}, self.cur)
        self.cur.children.append(node)
        if tag not in _VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(_Node(tag, {k: (v or "") for k, v in attrs}, self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def parse_html(html: str) -> _Node:
    b = _TreeBuilder()
    b.feed(html or "")
    b.close()
    return b.root


# Plain markup, on which any HTML parser agrees: whole tags with well-formed
# attributes, simple comments and doctypes, scripts and styles without markup
# declarations. Anything else goes through ``parse_html``.
_WS = "[ \\t\\n\\r\\f]"
_ATTRIBUTE = _WS + r"""+[a-zA-Z][-a-zA-Z0-9_]*(?:=(?:"[^"<>]*"|'[^'<>]*'|[^\s"'=<>`]+))?"""
_PLAIN = re.compile(
    r"([^<\0]*)(?:<([a-zA-Z][a-zA-Z0-9]*)((?:" + _ATTRIBUTE + ")*)" + _WS + r"*(/?)>|</([a-zA-Z][a-zA-Z0-9]*)" + _WS
    + r"*>|<!--(?!-?>)[^-\0]*(?:-[^-\0]+)*-->|<!(?:doctype|DOCTYPE)" + _WS + r"[a-zA-Z ]+>|\Z)")
_ATTRIBUTES = re.compile(r"""([a-zA-Z][-a-zA-Z0-9_]*)(?:=(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_CODE_END = {t: re.compile(f"(?i)</{t}>") for t in ("script", "style")}
#: Elements whose content some parser versions read as text.
_OTHERWISE = {"title", "textarea", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext", "svg", "math"}
_OPEN_REFERENCE = re.compile(r"&(?![a-zA-Z0-9#]+;)")


class _Page:
    """A plain page as one sequence of texts and element numbers, in page
    order: an element's descendants are the stretch ``first`` to ``last``."""
    __slots__ = ("events", "tags", "raw", "first", "last", "by_tag")

    def __init__(self):
        self.events, self.tags, self.raw, self.first, self.last, self.by_tag = [], [], [], [], [], {}


@lru_cache(1000)
def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): (unescape(v) if "&" in v else v) for k, *values in _ATTRIBUTES.findall(raw) for v in ("".join(values),)}


@lru_cache(1000)
def _has_class(raw: str, cls: str) -> bool:
    return cls in _attributes(raw).get("class", "").split()


def _scan(html: str) -> Optional[_Page]:
    """The page, or None where it is not plain."""
    page = _Page()
    events, tags, raw, first, last, by_tag = page.events, page.tags, page.raw, page.first, page.last, page.by_tag
    opened, at, n, match = [], 0, len(html), _PLAIN.match
    while at < n:
        m = match(html, at)
        if m is None:
            return None
        text, tag, attributes, closed, end = m.groups()
        at = m.end()
        if text:
            events.append(unescape(text) if "&" in text else text)
        if tag:
            tag, i = tag.lower(), len(tags)
            if tag in _OTHERWISE:
                return None
            events.append(i)
            tags.append(tag)
            raw.append(attributes)
            first.append(len(events))
            last.append(len(events))
            by_tag.setdefault(tag, []).append(i)
            if not closed and tag not in _VOID:
                opened.append(i)
            if tag in _CODE_END:
                stop = None if closed else _CODE_END[tag].search(html, at)
                if stop is None or "</" in html[at:stop.start()] or "<!" in html[at:stop.start()]:
                    return None
                at = stop.start()
        elif end:
            end = end.lower()
            for k in range(len(opened) - 1, -1, -1):
                if tags[opened[k]] == end:
                    for i in opened[k:]:
                        last[i] = len(events)
                    del opened[k:]
                    break
    for i in opened:
        last[i] = len(events)
    if any("&" in a and _OPEN_REFERENCE.search(a) for a in raw):
        return None
    return page


class _Element:
    """An element of a ``_Page`` (-1: the whole page), read like a ``_Node``."""
    __slots__ = ("page", "i")

    def __init__(self, page: _Page, i: int = -1):
        self.page, self.i = page, i

    @property
    def attrs(self) -> dict[str, str]:
        return _attributes(self.page.raw[self.i])

    def _span(self) -> tuple[int, int]:
        return (0, len(self.page.events)) if self.i < 0 else (self.page.first[self.i], self.page.last[self.i])

    def _matching(self, tag, cls=None) -> Iterator["_Element"]:
        page, (start, stop) = self.page, self._span()
        raw, first = page.raw, page.first
        for i in page.by_tag.get(tag, ()):
            if start < first[i] <= stop and (cls is None or cls in raw[i] and _has_class(raw[i], cls)):
                yield _Element(page, i)

    def find(self, tag, cls=None) -> Optional["_Element"]:
        return next(self._matching(tag, cls), None)

    def find_all(self, tag, cls=None):
        return list(self._matching(tag, cls))

    def strings(self):
        at, stop = self._span()
        while at < stop:
            event = self.page.events[at]
            at += 1
            if isinstance(event, str):
                yield event
            elif self.page.tags[event] in _HIDDEN:
                at = self.page.last[event]

    text = _Node.text


def page_root(html: str):
    """The root of a page's elements: of a plain page from one pass of a
    regular expression, else of the parser's tree."""
    page = _scan(html or "")
    return parse_html(html) if page is None else _Element(page)


def _nfc(s):
    return None if s is None else unicodedata.normalize("NFC", s)


def _first_text(node, selector: tuple, sep: str = "") -> Optional[str]:
    found = node.find(*selector)
    return None if found is None else _nfc(found.text(sep))


def _label_map(root, item: tuple, parts: tuple) -> list[tuple[str, str]]:
    """Label -> value of every item that has both; an extension is stored
    under the label with its suffix. The last of equal labels wins."""
    out: dict[str, str] = {}
    for node in root.find_all(*item):
        label, *values = (_first_text(node, p) for p in parts)
        if label is None or values[0] is None:
            continue
        out.update((label + suffix, v) for suffix, v in zip(("", S.EXT_SUFFIX), values) if v is not None)
    return list(out.items())


def extract_page(html: str, spec: PageSpec, fields=None) -> dict:
    """One page -> bronze fields (title "" when the title element is absent);
    only those named in ``fields`` are looked for, if given."""
    root = page_root(html)
    out: dict = {}
    wanted = [f.name for f in EXTRACT_FIELDS] if fields is None else fields
    if "has_title" in wanted or "title" in wanted:
        title = _first_text(root, spec.title)
        out["has_title"], out["title"] = title is not None, title or ""
    if "address" in wanted:
        out["address"] = _first_text(root, spec.address_1) or ""
    if "address_line_2" in wanted:
        out["address_line_2"] = (_first_text(root, spec.address_2) or "").strip("()")
    for name, (item, parts) in spec.maps().items():
        if name in wanted:
            out[name] = _label_map(root, item, parts)
    if "description" in wanted:
        out["description"] = _first_text(root, spec.description, "\n") or ""
    if "links" in wanted:
        hrefs = (a.attrs.get("href") for a in root.find_all(*spec.link))
        out["links"] = [h for h in hrefs if h]
    return out


EXTRACT_FIELDS = [
    T.StructField("has_title", T.BooleanType()),
    T.StructField("title", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("address_line_2", T.StringType()),
    T.StructField("short_info", S.STR_MAP),
    T.StructField("specs", S.STR_MAP),
    T.StructField("description", T.StringType()),
    T.StructField("links", T.ArrayType(T.StringType())),
]


def extract_documents(pages: DataFrame, spec: PageSpec = PageSpec(),
                      keep=("page_id", "url"), fields=None) -> DataFrame:
    """Parse every page (Arrow batches through ``mapInArrow``) into the
    bronze fields (those named in ``fields``, if given: Spark cannot prune what
    Python returns), keeping the ``keep`` columns alongside. Task memory is
    bounded by the Arrow batch cap (``spark.sql.execution.arrow.
    maxBytesPerBatch``, 64 MB by default), whatever the page sizes."""
    import pyarrow as pa

    from ..session import ship_package
    ship_package(pages.sparkSession)
    in_schema = pages.select(*keep, "html").schema
    wanted = [f for f in EXTRACT_FIELDS if fields is None or f.name in fields]
    out_schema = T.StructType([in_schema[c] for c in keep] + wanted)
    arrow_fields = {
        "has_title": pa.bool_(), "title": pa.string(), "address": pa.string(),
        "address_line_2": pa.string(), "short_info": pa.map_(pa.string(), pa.string()),
        "specs": pa.map_(pa.string(), pa.string()), "description": pa.string(),
        "links": pa.list_(pa.string()),
    }
    keep_cols, names = list(keep), [f.name for f in wanted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            htmls = batch.column("html").to_pylist()
            rows = [extract_page(h, spec, names) for h in htmls]
            arrays = [batch.column(c) for c in keep_cols]
            arrays += [pa.array([r[f] for r in rows], type=arrow_fields[f]) for f in names]
            yield pa.RecordBatch.from_arrays(arrays, names=keep_cols + names)

    return pages.select(*keep, "html").mapInArrow(run, out_schema)


def bronze_from_pages(extracted: DataFrame, crawled_at=None) -> DataFrame:
    """Valid pages (title element present) as bronze rows; ``crawled_at`` is
    the extraction time unless given."""
    stamp = F.current_timestamp() if crawled_at is None else F.lit(crawled_at).cast("timestamp")
    return (extracted.filter(F.col("has_title"))
            .select("url", "title", "address", "address_line_2", "short_info", "specs",
                    "description",
                    F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("crawled_at")))


def rejected_pages(extracted: DataFrame) -> DataFrame:
    """Pages without the title element (blocked or empty): not stored."""
    return extracted.filter(~F.col("has_title"))
