"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Defaults the curated layer is defined with.
NO_LETTERS = "na"
MISSING_PROFESSION = "not provided"
MISSING_DELTA_PROFESSION = "na"
MISSING_RAW_PROFESSION = "unknown"
MISSING_PRODUCT = "NA"
MISSING_TEXT = "na"
MISSING_PLACE = "unknown"


def full_name(first: Column, last: Column, separator: str = " ") -> Column:
    """Both names joined; null when either part is null (so not ``concat_ws``)."""
    return F.concat(first, F.lit(separator), last)


def default_if_null(value: Column, *fallbacks) -> Column:
    """First non-null of ``value`` and the fallbacks (columns or plain values)."""
    return F.coalesce(value, *[f if isinstance(f, Column) else F.lit(f) for f in fallbacks])


def id_number(mixed: Column, strict: bool = False) -> Column:
    """Digits of a mixed id as a number: ``'34P'`` gives 34.

    An id without digits gives null, or fails the query when ``strict``.
    """
    digits = F.regexp_replace(mixed, "[^0-9]", "")
    return digits.cast("bigint") if strict else digits.try_cast("bigint")


def id_letters(mixed: Column) -> Column:
    """Lower-case letters of a mixed id, ``'na'`` when it has none or is null."""
    letters = F.regexp_replace(F.lower(mixed), "[^a-z]", "")
    return F.coalesce(F.nullif(letters, F.lit("")), F.lit(NO_LETTERS))


def has_token(text: Column, word: str) -> Column:
    """Case-insensitive whole-token search, null for null text.

    ``'Outdoor-play'`` holds the token ``outdoor``; ``'Outdoors'`` does not.
    """
    return F.array_contains(F.split(F.lower(text), "[^a-z0-9]+"), word.lower())


def position_of(text: Column, piece: str) -> Column:
    """1-based position of ``piece`` (case-sensitive), 0 when absent."""
    return F.instr(text, piece)


def pad_right(text: Column, width: int, fill: str = " ") -> Column:
    """Pad to ``width`` characters; longer text is cut to ``width``."""
    return F.rpad(text, width, fill)


def last_chars(text: Column, n: int) -> Column:
    return F.right(text, F.lit(n))


def text_profile(text: Column, word: str, piece: str, width: int) -> dict[str, Column]:
    """The outbound report's five views of one text column."""
    return {
        "has_token": has_token(text, word),
        "position": position_of(text, piece),
        "padded": pad_right(text, width),
        "reversed": F.reverse(text),
        "n_chars": F.char_length(text),
    }
