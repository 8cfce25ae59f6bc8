"""Row predicates (Column -> boolean Column). Combine with ``&``; pass to
``DataFrame.filter`` so Catalyst can push what it can into the scan."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S
from .text import _c, split_parts


def not_blank(c) -> Column:
    """Not NULL and not only spaces (Spark ``trim`` removes spaces only)."""
    x = _c(c)
    return x.isNotNull() & (F.trim(x) != "")


def min_parts(c, n: int = 2, sep: str = ",") -> Column:
    """At least ``n`` separated parts; a NULL string never passes."""
    return F.coalesce(F.size(split_parts(c, sep)) >= n, F.lit(False))


def matches(c, pattern: str) -> Column:
    """Regex find (e.g. the ward-level test)."""
    return F.coalesce(_c(c).rlike(pattern), F.lit(False))


def is_ward(c, pattern: str = S.WARD_PATTERN) -> Column:
    return matches(c, pattern)


def equals_unless_all(c, value, sentinel: str = S.ALL_SENTINEL) -> Column:
    """Equality filter that is switched off by the "all" sentinel or None."""
    if value is None or value == sentinel:
        return F.lit(True)
    return _c(c) == value


def in_range(c, lo, hi) -> Column:
    """Inclusive range; NULL values never pass (either bound None = open)."""
    x = _c(c)
    cond = x.isNotNull()
    if lo is not None:
        cond = cond & (x >= lo)
    if hi is not None:
        cond = cond & (x <= hi)
    return cond


def in_list(c, values: Sequence | None) -> Column:
    """Membership, skipped (always true) when the list is empty."""
    if not values:
        return F.lit(True)
    return _c(c).isin(list(values))


def keeps_link(href, domain) -> Column:
    """Drop absolute links that do not contain the domain; keep the rest."""
    h = _c(href)
    d = F.lit(domain) if isinstance(domain, str) else domain
    return h.isNotNull() & ~(h.startswith("http") & ~F.contains(h, d))


def all_of(conds: Iterable[Column]) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out
