"""Text predicates under the survey's case rule, and name clean-up helpers.

The remote server compares text case-insensitively (SURVEY Q1), so the default
for every LIKE / equality on soil text is case-insensitive; pass
``case_sensitive=True`` for the other reading.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F


def like(col: Column | str, pattern: str, case_sensitive: bool = False) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.like(pattern) if case_sensitive else c.ilike(pattern)


def not_like(col: Column | str, pattern: str, case_sensitive: bool = False) -> Column:
    """SQL ``NOT LIKE``: NULL input stays NULL, so a filter drops it."""
    return ~like(col, pattern, case_sensitive)


def _spellings(value: str) -> list[str]:
    return ["".join(x) for x in product(*[sorted({c.lower(), c.upper()}) for c in value])]


def text_eq(col: Column | str, value: str, case_sensitive: bool = False) -> Column:
    """Equality under the case rule.

    A short flag is compared with all its spellings, which reaches the Parquet
    scan as an ``IN`` filter; a longer text is lower-cased.
    """
    c = F.col(col) if isinstance(col, str) else col
    if case_sensitive:
        return c == F.lit(value)
    if len(value) <= 3 and value.isascii():
        return c.isin(_spellings(value))
    return F.lower(c) == F.lit(value.lower())


def any_like(col: Column | str, patterns: list[str], case_sensitive: bool = False) -> Column:
    """True where the column matches one of the LIKE patterns (never for an empty list)."""
    found = F.lit(False)
    for p in patterns:
        found = found | like(col, p, case_sensitive)
    return found


def text_ne(col: Column | str, value: str, case_sensitive: bool = False) -> Column:
    """SQL ``!=``: NULL input yields NULL (not counted / filtered out)."""
    c = F.col(col) if isinstance(col, str) else col
    return c != F.lit(value) if case_sensitive else F.lower(c) != F.lit(value.lower())


def request_list(text: str | Iterable[str]) -> list[str]:
    """Requests of a ``;``-separated text (or a list): blanks and quotes around each dropped, ``{:}`` read as ``;``."""
    parts = text.split(";") if isinstance(text, str) else list(text)
    clean = [p.strip().strip("'\"").replace("{:}", ";") for p in parts]
    return list(dict.fromkeys(p for p in clean if p))


def report_rule_name(name: str) -> str:
    """A rule name as the report tools take it: the site prefix up to the first ``:`` and quotes dropped, ``{:}`` read as ``;``."""
    bare = re.sub("^[^:{]*:", "", name)
    return re.sub("[\"']", "", bare).replace("{:}", ";").strip()


# XML entities the tabular service escapes in reason text, in the
# order they are undone (ampersand last).
XML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")]


def unescape_entities(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    for ent, ch in XML_ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c
