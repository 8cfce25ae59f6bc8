"""Column -> Column scalar rules (no actions, all JVM-side built-ins).

ANSI mode is on in Spark 4, so every rule that must turn a bad value into
NULL uses a ``try_*`` function instead of a plain cast or index.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_string() -> Column:
    """A typed NULL string literal (missing field placeholder)."""
    return F.lit(None).cast("string")


def map_field(m, key: str) -> Column:
    """Value of ``key`` in a map column; NULL when the key or map is absent."""
    return _c(m).getItem(key)


def struct_or_map_field(df, container: str, key: str) -> Column:
    """Schema-tolerant nested field: ``container[key]`` when the container is
    a map or a struct that has the field, else a NULL string."""
    from pyspark.sql import types as T
    if container not in df.columns:
        return null_string()
    dtype = df.schema[container].dataType
    if isinstance(dtype, T.MapType):
        return F.col(container).getItem(key)
    if isinstance(dtype, T.StructType) and key in dtype.fieldNames():
        return F.col(container).getField(key)
    return null_string()


def json_field(js, path: str) -> Column:
    """Scalar at a JSON path as a string; NULL when absent or unparsable."""
    return F.get_json_object(_c(js), path)


def json_map(js) -> Column:
    """Parse a JSON object into map<string,string>; a repeated key keeps the
    last value."""
    return last_wins(F.from_json(_c(js), "map<string,string>"))


def last_wins(m) -> Column:
    """Drop every map entry whose key occurs again later (dict semantics).
    Quadratic in the map size, meant for small label maps."""
    entries = F.map_entries(_c(m))
    n = F.size(entries)

    def keep(e, i):
        later = F.slice(entries, i + 2, F.greatest(n - i - 1, F.lit(0)))
        return ~F.exists(later, lambda x: x["key"] == e["key"])
    return F.when(_c(m).isNull(), F.lit(None)).otherwise(
        F.map_from_entries(F.filter(entries, keep)))


def locale_number(c) -> Column:
    """Decimal-comma number: keep digits and commas, comma -> dot, to double.

    Units and ranges are not interpreted ("2 - 3" gives 23.0, "1,5 - 2,5" is
    NULL) — these are the source system's rules, kept on purpose.
    """
    digits = F.regexp_replace(_c(c), "[^0-9,]", "")
    return F.replace(digits, F.lit(","), F.lit(".")).try_cast("double")


def digits_int(c) -> Column:
    """All digits of the string as an int; NULL when there are none."""
    return F.regexp_replace(_c(c), "[^0-9]", "").try_cast("int")


def parse_date(c, fmt: str = S.POSTED_DATE_FORMAT) -> Column:
    """Strict date parse; NULL when the text does not fit ``fmt``."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("date")


def parse_timestamp(c) -> Column:
    """ISO-8601 text without zone (fraction optional) -> TIMESTAMP_NTZ, NULL
    when invalid. Zone-less text stays zone-less: the value (and the date
    derived from it) does not depend on the session time zone."""
    return _c(c).try_cast("timestamp_ntz")


def to_day(c) -> Column:
    """Timestamp -> date."""
    return F.to_date(_c(c))


def split_parts(c, sep: str = ",") -> Column:
    return F.split(_c(c), sep)


def part(c, index: int, sep: str = ",") -> Column:
    """1-based trimmed part of a separated string, NULL past the end."""
    return F.trim(F.try_element_at(split_parts(c, sep), F.lit(index)))


def strip_pattern(c, pattern: str) -> Column:
    """Remove every match of a regex (e.g. an administrative prefix)."""
    return F.regexp_replace(_c(c), pattern, "")


def strip_district_prefix(c, pattern: str = S.DISTRICT_PREFIX_PATTERN) -> Column:
    return strip_pattern(c, pattern)


def strip_city_suffix(c, pattern: str = S.CITY_SUFFIX_PATTERN) -> Column:
    return strip_pattern(c, pattern)


def keyword_flag(c, keywords: Iterable[str] = S.LEGAL_KEYWORDS) -> Column:
    """1 when the lower-cased text contains any keyword, else 0 (NULL -> 0)."""
    low = F.lower(_c(c))
    hit = reduce(lambda a, b: a | b, [low.contains(k) for k in keywords])
    return F.when(hit, 1).otherwise(0)


def first_meaningful_part(c, sep: str = ",",
                          token_pattern: str = S.SHORT_TOKEN_PATTERN,
                          skip_prefix: str = S.HOUSE_NUMBER_PREFIX) -> Column:
    """First address part that is neither a short ASCII token nor starts with
    ``skip_prefix`` (case-insensitive), trimmed; NULL when none is left."""
    def keep(x: Column) -> Column:
        t = F.trim(x)
        return ~(t.rlike(token_pattern) | F.lower(t).startswith(skip_prefix))
    return F.trim(F.get(F.filter(split_parts(c, sep), keep), 0))


def to_double(c) -> Column:
    """Numeric coercion: bad text and the text ``NaN`` -> NULL."""
    return nan_to_null(_c(c).try_cast("double"))


def absolute_url(href, domain) -> Column:
    """Relative link -> domain + link; absolute links unchanged."""
    h = _c(href)
    d = F.lit(domain) if isinstance(domain, str) else domain
    return F.when(h.startswith("http"), h).otherwise(F.concat(d, h))


def is_foreign_link(href, domain) -> Column:
    """Absolute link whose text does not contain the domain (substring test)."""
    h = _c(href)
    d = F.lit(domain) if isinstance(domain, str) else domain
    return h.startswith("http") & ~F.contains(h, d)


def url_slug(url) -> Column:
    """Last path segment after stripping surrounding slashes."""
    stripped = F.btrim(_c(url), F.lit("/"))
    return F.element_at(F.split(stripped, "/"), -1)


def strip_chars(c, chars: str) -> Column:
    """Remove any mix of ``chars`` from both ends (e.g. parentheses)."""
    return F.btrim(_c(c), F.lit(chars))


def page_url(base, page) -> Column:
    """Paging URL: ``/p{n}`` appended only when n > 1."""
    b, p = _c(base), _c(page)
    return F.when(p > 1, F.concat(b, F.lit("/p"), p.cast("string"))).otherwise(b)


def next_page(page, n_links) -> Column:
    """Cursor advance: next page when links were found, else back to 1."""
    return F.when(_c(n_links) > 0, _c(page) + 1).otherwise(F.lit(S.FIRST_PAGE))


def nan_to_null(c) -> Column:
    """NaN -> NULL, so averages skip it like pandas does."""
    return F.nanvl(_c(c), F.lit(None).cast("double"))
