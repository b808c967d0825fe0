"""Small text building blocks used by all extraction and review expressions.

Patterns run with Unicode classes, Unicode case folding and newline-only line ends, so ``\\s``,
``\\d``, ``\\b``, ``.`` and ``$`` mean what they mean in the labelled data (Korean text, NBSP).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ANY_CASE = "(?iudU)"
SAME_CASE = "(?dU)"
SPACE = r"[\s\x1c-\x1f]"


def nonempty(col: Column) -> Column:
    """Null instead of the empty string.

    Names ``col`` once: ``nullif`` copies its argument inside ``coalesce`` and ``when`` branches,
    which doubles the expression at every level of a fallback chain.
    """
    return F.get(F.array_remove(F.array(col), ""), F.lit(0))


def strip(col: Column) -> Column:
    return F.regexp_replace(col, f"{SAME_CASE}^{SPACE}+|{SPACE}+\\z", "")


def squash(col: Column) -> Column:
    """One space for every run of white space, none at the ends."""
    return F.trim(F.regexp_replace(col, f"{SAME_CASE}{SPACE}+", " "))


def strip_chars(col: Column, characters: str) -> Column:
    return F.btrim(col, F.lit(characters))


def find(col: Column, pattern: str) -> Column:
    """First match of a one-group pattern in any case, trimmed; null when absent or empty."""
    return nonempty(strip(F.regexp_extract(col, ANY_CASE + pattern, 1)))


def first_match(col: Column, patterns: Sequence[str]) -> Column:
    """Try patterns in order and return the captured text of the first that matches."""
    return F.coalesce(*[find(col, p) for p in patterns])


def contains_any(col: Column, phrases: Sequence[str]) -> Column:
    """True when the lower-cased text contains one of the phrases."""
    lowered = F.lower(col)
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | lowered.contains(phrase.lower())
    return F.coalesce(hit, F.lit(False))


def join_present(separator: str, *cols: Column) -> Column:
    """Join the texts that are neither null nor empty."""
    return F.concat_ws(separator, *[nonempty(c) for c in cols])


def tokens(col: Column) -> Column:
    """Words of an already squashed text; an empty array for null or empty text."""
    return F.filter(F.split(F.coalesce(squash(col), F.lit("")), " "), lambda t: t != "")


def literal_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def present(*pairs: tuple[Column, str]) -> Column:
    """Ordered array of the names whose condition holds."""
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for condition, name in pairs]))


def stable_number(*parts: Column | str | int) -> Column:
    """A 32-bit number drawn from the text of ``parts``: the same on every run and every layout."""
    text = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
