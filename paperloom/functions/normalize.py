"""Field normalisers: text in, text out, null when nothing usable is left."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.text import ANY_CASE, SAME_CASE, SPACE, find, nonempty, squash, strip_chars

UNITED_STATES = "United States of America"


def norm_name(col: Column) -> Column:
    text = strip_chars(squash(col), " ,;:")
    text = F.regexp_replace(text, r"(?U)(?<=\b[A-Z])\.(?=[A-Z])", ". ")
    text = F.regexp_replace(text, r"[^A-Za-z0-9 .,'-]", " ")
    return nonempty(squash(text))


def canonical_name(col: Column) -> Column:
    return F.coalesce(F.regexp_replace(F.lower(col), "[^a-z0-9]", ""), F.lit(""))


def norm_address(col: Column) -> Column:
    text = F.regexp_replace(col, r"[\n\r\t,]+", " ")
    return nonempty(squash(F.regexp_replace(text, r"[^A-Za-z0-9#.' -]", " ")))


def norm_country(col: Column) -> Column:
    text = squash(col)
    letters = F.lower(F.regexp_replace(text, "[^A-Za-z]", ""))
    american = (
        text.rlike(f"{ANY_CASE}united states")
        | (letters.contains("nitedstates") & letters.contains("america"))
        | text.rlike(rf"{ANY_CASE}\busa\b")
    )
    return F.when(american, F.lit(UNITED_STATES)).otherwise(nonempty(text))


def norm_country_code(col: Column) -> Column:
    code = nonempty(F.regexp_extract(F.upper(col), rf"{SAME_CASE}\b([A-Z]{{2}})\b", 1))
    return F.when(norm_country(col) == UNITED_STATES, F.lit("US")).otherwise(code)


def norm_percent(col: Column) -> Column:
    digits = nonempty(F.regexp_extract(col, r"(?U)(\d{1,2})", 1))
    return F.concat(digits, F.lit("%"))


def _without_leading_zeros(col: Column) -> Column:
    return F.regexp_replace(col, r"^0+(?=\d)", "")


def norm_english_date(col: Column) -> Column:
    """``Month d, yyyy``; a text without such a date stays as cleaned."""
    text = strip_chars(squash(nonempty(col)), " ,.;:")
    pattern = rf"{ANY_CASE}([A-Za-z]+)\s+(\d{{1,2}})(?:st|nd|rd|th)?[,.]?\s*(\d{{4}})"
    month, day, year = (F.regexp_extract(text, pattern, g) for g in (1, 2, 3))
    dated = F.concat(month, F.lit(" "), _without_leading_zeros(day), F.lit(", "), year)
    return F.when(month != "", dated).otherwise(nonempty(text))


def norm_iso_date(col: Column) -> Column:
    """``yyyy-mm-dd`` from Korean or punctuated dates; not parsed, so impossible days survive."""
    source = nonempty(col)
    packed = F.regexp_replace(source, f"{SAME_CASE}{SPACE}+", "")
    pattern = r"(?U)(\d{4})[년./-]?(\d{1,2})[월./-]?(\d{1,2})"
    year, month, day = (F.regexp_extract(packed, pattern, g) for g in (1, 2, 3))
    dated = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.when(year != "", dated).otherwise(squash(source))


def norm_apostille_date(col: Column) -> Column:
    text = F.regexp_replace(squash(nonempty(col)), r"(?U)([A-Za-z])(\d{4})", "$1, $2")
    return nonempty(strip_chars(squash(text), " ,;:"))


def norm_authority(col: Column) -> Column:
    return nonempty(squash(F.replace(nonempty(col), F.lit("StateState"), F.lit("State State"))))


def item_block(col: Column, number: int) -> Column:
    """Text of a numbered item, up to the next number or to the end; '' when absent."""
    following = find(col, rf"{number}\.?\s*(.+?)(?=\s+{number + 1}\.?\s)")
    return F.coalesce(following, find(col, rf"{number}\.?\s*(.+)$"), F.lit(""))


def clean_item(col: Column, stops: Sequence[str] = (), commas: bool = False) -> Column:
    """Drop rules, bars and everything from a stop phrase on; null without a letter or digit."""
    text = F.regexp_replace(squash(col), r"[_|]+", " ")
    text = F.regexp_replace(text, rf"{SAME_CASE}^(?:Country:|COUNTRY:)\s*", "")
    text = F.regexp_replace(text, rf"{ANY_CASE}^10\.\s*Signature\s*$", "")
    for phrase in stops:
        text = F.trim(F.regexp_replace(text, rf"(?isu)\Q{phrase}\E.*", ""))
    if commas:
        text = F.regexp_replace(text, rf"{SAME_CASE}\s*,\s*", ", ")
    text = strip_chars(text, " :;|\\/")
    return nonempty(F.regexp_replace(text, r"\A[^\p{L}\p{N}]*\z", ""))


def norm_capacity(col: Column) -> Column:
    return nonempty(F.trim(F.regexp_replace(col, rf"{SAME_CASE}\s+\d+$", "")))


def norm_issuing_country(col: Column) -> Column:
    letters = F.upper(F.regexp_replace(col, "[^A-Za-z]", ""))
    return F.when(letters.endswith("STATESOFAMERICA"), F.lit("UNITED STATES OF AMERICA")).otherwise(nonempty(col))
