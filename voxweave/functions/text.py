"""String column builders. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K

# Patterns. BLANK is every character a Unicode-aware split treats as blank.
TAG = r"<[^>]*>"
BRACE = r"\{[^}]*\}"
BLANK = r"\s\x1c-\x1f"
SPACE_RUN = f"(?U)[{BLANK}]++"
EDGE_SPACE = f"(?U)^[{BLANK}]++|[{BLANK}]++$"
NON_SPACE = f"(?U)[^{BLANK}]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_spaces(c: Column | str) -> Column:
    """Trim every kind of Unicode blank (``trim`` removes U+0020 only)."""
    return F.regexp_replace(_col(c), EDGE_SPACE, "")


def is_blank(c: Column | str) -> Column:
    """True for null, empty or only blanks. The start usually decides; the whole text is read only when it does not."""
    c = _col(c)
    filled = F.substring(c, 1, 32).rlike(NON_SPACE) | c.rlike(NON_SPACE)
    return ~F.coalesce(filled, F.lit(False))


def collapse_whitespace(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(c), SPACE_RUN, " "))


def clean_dialog_text(c: Column | str) -> Column:
    """Drop ``<...>``, then ``{...}``, collapse blanks; null gives the empty string.

    Text without an opening sign skips that pattern.
    """
    c = _col(c)
    untagged = F.when(c.contains("<"), F.regexp_replace(c, TAG, "")).otherwise(c)
    bare = F.when(c.contains("{"), F.regexp_replace(untagged, BRACE, "")).otherwise(untagged)
    return F.coalesce(collapse_whitespace(bare), F.lit(""))


def has_dialog_text(c: Column | str) -> Column:
    """Whether ``clean_dialog_text`` leaves anything.

    A predicate on the raw text: it reaches the scan side of a plan without cleaning every row a second time,
    because only rows with an opening sign need the patterns.
    """
    c = _col(c)
    marked = c.contains("<") | c.contains("{")
    left = F.when(marked, clean_dialog_text(c) != "").otherwise(~is_blank(c))
    return F.coalesce(left, F.lit(False))


def normalize_language(c: Column | str) -> Column:
    """Fold spelling variants; other values are only trimmed and lower-cased; null stays null."""
    names = {v: name for name, variants in K.LANGUAGE_ALIASES.items() for v in variants}
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    folded = F.lower(strip_spaces(_col(c).cast("string")))
    return F.coalesce(F.try_element_at(known, folded), folded)


def match_key(text: Column | str, speaker: Column | str, language: Column | str) -> Column:
    """``text||speaker||language`` of a cleaned row; null when no text is left."""
    cleaned = clean_dialog_text(text)
    key = F.concat(
        cleaned,
        F.lit("||"),
        F.coalesce(strip_spaces(_col(speaker).cast("string")), F.lit("")),
        F.lit("||"),
        F.coalesce(normalize_language(language), F.lit("")),
    )
    return F.when(has_dialog_text(text), key)


def first_existing(columns: Sequence[str], wanted: Sequence[str]) -> str | None:
    """First wanted name that exists. A plan-time choice: a null value never falls through to the next name."""
    return next((name for name in wanted if name in columns), None)


def assistant_prompt(text: Column | str) -> Column:
    return F.concat(F.lit(K.ASSISTANT_HEAD), _col(text), F.lit(K.TURN_END), F.lit(K.ASSISTANT_HEAD))


def reference_prompt(text: Column | str) -> Column:
    """Null when there is no reference text."""
    filled = F.concat(F.lit(K.ASSISTANT_HEAD), _col(text), F.lit(K.TURN_END))
    return F.when(_col(text) != "", filled)


def instruct_prompt(text: Column | str) -> Column:
    """Null when there is no instruction."""
    filled = F.concat(F.lit(K.USER_HEAD), _col(text), F.lit(K.TURN_END))
    return F.when(_col(text) != "", filled)


def fetch_name(url: Column | str, index: Column | str) -> Column:
    """``{index}_{last path segment}`` for a URL, with a fixed fallback when the path has no last segment."""
    path = F.regexp_extract(_col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    last = F.regexp_extract(path, r"([^/]*)$", 1)
    fallback = F.format_string(K.FETCH_FALLBACK_NAME, _col(index))
    return F.concat(_col(index).cast("string"), F.lit("_"), F.when(last != "", last).otherwise(fallback))
