"""Text expressions. All are native column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that define the reports' text semantics.
TAG_PATTERN = r"<[^>]+>"
NON_WORD_PATTERN = r"[^\p{L}\p{N}]+"
NON_DIGIT_PATTERN = r"[^0-9]"
NON_PLATE_PATTERN = r"[^A-Z0-9]"
DECIMAL_PATTERN = r"([0-9]+[.,][0-9]+)"


def strip_tags(text: Column, replacement: str = "") -> Column:
    return F.regexp_replace(text, TAG_PATTERN, replacement)


def clean_message(text: Column) -> Column:
    """Every run of characters that is neither letter nor digit becomes one space; lower case.

    NULL becomes the empty string.
    """
    return F.lower(F.coalesce(F.regexp_replace(text, NON_WORD_PATTERN, " "), F.lit("")))


def words(text: Column, min_length: int = 2) -> Column:
    """Tokens of a cleaned text with at least ``min_length`` characters."""
    return F.filter(F.split(text, " "), lambda t: F.length(t) >= min_length)


def bigrams(tokens: Column) -> Column:
    """Neighbouring token pairs joined by one space; empty for fewer than two tokens."""
    following = F.slice(tokens, F.lit(2), F.size(tokens))
    pairs = F.zip_with(tokens, following, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(pairs, lambda pair: pair.isNotNull())


def split_list(text: Column, separator: str = ",") -> Column:
    """Split a delimited list, trim the parts and drop the empty ones."""
    parts = F.transform(F.split(text, separator), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def digits_only(text: Column, when_missing: str = "0") -> Column:
    return F.coalesce(F.regexp_replace(text, NON_DIGIT_PATTERN, ""), F.lit(when_missing))


def comma_to_point(text: Column, when_missing: str = "0") -> Column:
    return F.coalesce(F.replace(text, F.lit(","), F.lit(".")), F.lit(when_missing))


def first_decimal(text: Column, accept_integers: bool = False) -> Column:
    """First decimal number (comma or point) in a text, else 0.0.

    A number without decimals counts as 0.0 unless ``accept_integers`` is set.
    """
    pattern = r"([0-9]+(?:[.,][0-9]+)?)" if accept_integers else DECIMAL_PATTERN
    found = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    return F.coalesce(F.replace(found, F.lit(","), F.lit(".")).cast("double"), F.lit(0.0))


def plate_key(text: Column) -> Column:
    """Lookup key of a plate: upper case, letters and digits only."""
    return F.regexp_replace(F.upper(text), NON_PLATE_PATTERN, "")


def ocr_plate(text: Column) -> Column:
    """Reader-side clean-up of a plate: upper case without spaces and dashes."""
    return F.regexp_replace(F.upper(text), "[ -]", "")


def shorten(text: Column, length: int = 500, suffix: str = "...") -> Column:
    """The first ``length`` characters followed by ``suffix`` (added to short texts too)."""
    return F.concat(F.substring(text, 1, length), F.lit(suffix))


def first_filled(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])


def absolute_url(url: Column, base: str) -> Column:
    """Keep a URL that contains ``http``, else put ``base`` in front (NULL counts as '')."""
    return F.when(F.contains(url, F.lit("http")), url).otherwise(
        F.concat(F.lit(base), F.coalesce(url, F.lit("")))
    )


def join_fragments(fragments: Column, separator: str = " ") -> Column:
    """Join text fragments after trimming them and dropping blank ones."""
    trimmed = F.transform(fragments, lambda p: F.trim(p))
    return F.array_join(F.filter(trimmed, lambda p: p != ""), separator)


def matches_search(columns: list[Column], needle: str) -> Column:
    """Case-insensitive "contains" over several columns."""
    wanted = F.lit(needle.lower())
    hits = [F.coalesce(F.contains(F.lower(c), wanted), F.lit(False)) for c in columns]
    found = hits[0]
    for hit in hits[1:]:
        found = found | hit
    return found
