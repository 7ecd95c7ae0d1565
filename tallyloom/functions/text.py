"""Text functions C1-C23: identifiers, label cleaning, short links, keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
# Code point ranges that the label cleaners delete. ``basic`` and ``math`` and
# ``broad`` include U+24C2-U+1F251, which also covers CJK and Hangul; they are
# kept for equal results. ``emoji_only`` leaves scripts alone.
EMOJI_RANGES = {
    "basic": [
        (0x1F600, 0x1F64F),
        (0x1F300, 0x1F5FF),
        (0x1F680, 0x1F6FF),
        (0x1F1E0, 0x1F1FF),
        (0x2702, 0x27B0),
        (0x24C2, 0x1F251),
    ],
    "math": [
        (0x1F600, 0x1F64F),
        (0x1F300, 0x1F5FF),
        (0x1F680, 0x1F6FF),
        (0x1F1E0, 0x1F1FF),
        (0x2702, 0x27B0),
        (0x24C2, 0x1F251),
        (0x1D400, 0x1D7FF),
    ],
    "broad": [
        (0x1F600, 0x1F64F),
        (0x1F300, 0x1F5FF),
        (0x1F680, 0x1F6FF),
        (0x1F1E0, 0x1F1FF),
        (0x2500, 0x2BEF),
        (0x2702, 0x27B0),
        (0x24C2, 0x1F251),
        (0x1F926, 0x1F937),
        (0x10000, 0x10FFFF),
        (0x2640, 0x2642),
        (0x2600, 0x2B55),
        (0x200D, 0x200D),
        (0x23CF, 0x23CF),
        (0x23E9, 0x23E9),
        (0x231A, 0x231A),
        (0xFE0F, 0xFE0F),
        (0x3030, 0x3030),
    ],
    "emoji_only": [
        (0x1F300, 0x1F5FF),
        (0x1F600, 0x1F64F),
        (0x1F680, 0x1F6FF),
        (0x1F900, 0x1F9FF),
        (0x1F1E0, 0x1F1FF),
        (0x2600, 0x27BF),
        (0xFE0F, 0xFE0F),
        (0x200D, 0x200D),
    ],
}
# Blanks beyond ASCII, to stand inside a character class: blank and separator characters of Unicode.
WIDE_BLANKS = r"\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
BLANKS = rf"\s\x{{B}}{WIDE_BLANKS}"
SHORT_LINK = rf"(?i)https?://bit\.ly/[^{BLANKS}]+"
ACCOUNT_URN = "urn:li:sponsoredAccount:"
CONVERSION_PREFIX = "offsite_conversion.custom."
POST_URL = "https://www.linkedin.com/feed/update/"
# ----------------------------------------------------------------------------


def _char_class(ranges: list[tuple[int, int]]) -> str:
    parts = [rf"\x{{{lo:X}}}" if lo == hi else rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in ranges]
    return "[" + "".join(parts) + "]+"


def emoji_pattern(profile: str = "basic") -> str:
    """Regex of one profile; valid in Java and RE2 alike."""
    return _char_class(EMOJI_RANGES[profile])


def _null_if_empty(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


# ------------------------------------------------------------- identifiers
def urn_digits(col: Column) -> Column:
    """First run of digits, or the value itself when it holds none."""
    text = col.cast("string")
    return F.coalesce(_null_if_empty(F.regexp_extract(text, r"\d+", 0)), text)


def urn_tail(col: Column) -> Column:
    """Part after the last colon; null and empty give empty text."""
    return F.coalesce(F.substring_index(col, ":", -1), F.lit(""))


def urn_account(col: Column) -> Column:
    """C4: account id of a sponsored-account URN; other values unchanged."""
    return F.when(col.contains(ACCOUNT_URN), F.substring_index(col, ACCOUNT_URN, -1)).otherwise(col)


def urn_part(col: Column, urn_type: str) -> Column:
    """Text after ``:<type>:``, else after the last colon; empty gives null."""
    marker = f":{urn_type}:"
    tail = F.when(col.contains(marker), F.substring_index(col, marker, -1)).otherwise(F.substring_index(col, ":", -1))
    return F.when(col != "", tail)


def pivot_value(values: Column, urn_type: str) -> Column:
    """C5 on the first item of an array of URNs."""
    return urn_part(F.get(values, F.lit(0)), urn_type)


def urn_kind(col: Column) -> Column:
    """``ugcPost``, ``share`` or ``unknown``."""
    return F.when(col.contains("ugcPost"), "ugcPost").when(col.contains("share"), "share").otherwise("unknown")


def resource_id(col: Column) -> Column:
    """Ad group id inside a resource name, decided row by row (trap T11)."""
    return F.coalesce(
        _null_if_empty(F.regexp_extract(col, r"/groupPlacementViews/(\d+)", 1)),
        _null_if_empty(F.regexp_extract(col, r"/adGroups/(\d+)", 1)),
    )


def custom_conversion_id(col: Column) -> Column:
    """Text after the custom-conversion prefix, dots taken literally (trap T12)."""
    return _null_if_empty(F.regexp_extract(col, re.escape(CONVERSION_PREFIX) + r"([^.]+)", 1))


# ----------------------------------------------------------- label cleaning
def _if_wide(col: Column, cleaned: Column) -> Column:
    """``cleaned`` only where the text leaves ASCII; a byte count decides, far cheaper than a regex."""
    return F.when(F.octet_length(col) == F.char_length(col), col).otherwise(cleaned)


def strip_emoji(col: Column, profile: str = "basic") -> Column:
    """C10. The leading range turns ASCII letters away with one comparison instead of one per range."""
    ranges = emoji_pattern(profile).removesuffix("+")
    return _if_wide(col, F.regexp_replace(col, rf"[\x{{200D}}-\x{{10FFFF}}&&{ranges}]+", ""))


def keep_latin(col: Column) -> Column:
    """C11: ASCII letters, digits, blanks and common punctuation."""
    return F.regexp_replace(col, rf"""[^a-zA-Z0-9{BLANKS}\-.,;:!?()\[\]'"]+""", "")


def ascii_only(col: Column) -> Column:
    """C11 variant."""
    return _if_wide(col, F.regexp_replace(col, r"[^\x00-\x7F]+", ""))


def swap_pipe(col: Column, with_: str = "-") -> Column:
    """Pipe to ``-``; pass ``with_=''`` to drop it."""
    return F.replace(col, F.lit("|"), F.lit(with_))


def clean_label(col: Column, profile: str = "pipe") -> Column:
    """``pipe`` only, ``emoji`` as well, or ``latin`` (emoji, then Latin filter, then pipe)."""
    if profile == "pipe":
        return swap_pipe(col)
    if profile == "emoji":
        return strip_emoji(swap_pipe(col))
    if profile == "latin":
        return swap_pipe(keep_latin(strip_emoji(col)))
    raise ValueError(f"unknown label profile {profile!r}")


def audience_label(col: Column) -> Column:
    """C13."""
    return F.regexp_replace(col, rf"[^a-zA-Z0-9{BLANKS}\-_]", "")


def drop_vertical_prefix(col: Column) -> Column:
    """C13 variant: leading ``uservertical::`` removed."""
    return F.regexp_replace(col, r"^uservertical::", "")


def keep_word_chars(col: Column) -> Column:
    r"""C14: letters and digits of any script, ``_``, blanks, ``-`` and pipe."""
    return F.regexp_replace(col, rf"[^a-z A-Z0-9_{BLANKS}\-|\p{{L}}\p{{N}}]", "")


def clean_post_text(col: Column) -> Column:
    """Emoji out, line breaks to blanks, pipe to ``-``, NUL out; null gives empty."""
    text = F.regexp_replace(strip_emoji(col, "math"), r"\r\n|\n|\r", " ")
    return F.coalesce(F.replace(swap_pipe(text), F.lit("\x00"), F.lit("")), F.lit(""))


def find_between(col: Column, first: str, last: str) -> Column:
    """Text between the first ``first`` and the next ``last``; empty when absent."""
    return F.coalesce(F.regexp_extract(col, f"(?s){re.escape(first)}(.*?){re.escape(last)}", 1), F.lit(""))


# --------------------------------------------------------------- short links
def short_links(col: Column) -> Column:
    """C17: distinct links in text order."""
    return F.array_distinct(F.regexp_extract_all(col, F.lit(SHORT_LINK), F.lit(0)))


def count_short_links(col: Column) -> Column:
    return F.coalesce(F.size(short_links(col)), F.lit(0))


def has_short_link(col: Column) -> Column:
    """F15; null counts as no link."""
    return F.coalesce(col.rlike(SHORT_LINK), F.lit(False))


def link_id(col: Column) -> Column:
    """Link without its scheme."""
    return F.regexp_replace(col, r"^https?://", "")


# ------------------------------------------------------------ names and keys
def code_head(col: Column, sep: str = ".") -> Column:
    """C19."""
    return F.split_part(col, F.lit(sep), F.lit(1))


def copy_field(col: Column) -> Column:
    """C20: one field of a pipe-delimited export; backslash first, then pipe; null as ``None``."""
    text = F.replace(col.cast("string"), F.lit("\\"), F.lit("\\\\"))
    return F.coalesce(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("None"))


def copy_line(*cols: Column) -> Column:
    return F.concat_ws("|", *[copy_field(c) for c in cols])


def image_name(external_id: Column, newsletter_id: Column) -> Column:
    """C21."""
    return F.concat(F.coalesce(_null_if_empty(external_id), newsletter_id), F.lit(".png"))


def partition_key(col: Column) -> Column:
    """A date as ``yyyyMMdd``; any other key whole, so that different keys stay different partitions."""
    text = col.cast("string")
    day = F.date_format(F.substring(text, 1, 10).try_cast("date"), "yyyyMMdd")
    is_day = text.rlike(r"^\d{4}-\d{2}-\d{2}")
    return F.coalesce(F.when(is_day, day), text)


def row_key(*cols: Column, row: Column | None = None) -> Column:
    """Non-null parts joined by ``_``; without any, ``row-`` and the hash of the whole ``row``, so such rows don't meet under one key."""
    joined = F.concat_ws("_", *[c.cast("string") for c in cols])
    return joined if row is None else F.when(F.coalesce(*cols).isNull(), F.concat(F.lit("row-"), row)).otherwise(joined)


def post_url(col: Column) -> Column:
    """C23."""
    return F.concat(F.lit(POST_URL), F.coalesce(col, F.lit("")))


def to_urn(kind: str, col: Column) -> Column:
    """``urn:li:<kind>:<id>``; values that already are URNs stay."""
    text = col.cast("string")
    return F.when(text.startswith("urn:li:"), text).otherwise(F.concat(F.lit(f"urn:li:{kind}:"), text))


def placeholder_name(label: str, id_col: Column) -> Column:
    """``<label> <id>``; null id gives null."""
    return F.concat(F.lit(f"{label} "), id_col.cast("string"))
