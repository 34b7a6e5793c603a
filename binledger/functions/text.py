"""Text columns: padded keys, contract numbers, e-mail cleaning, file-name tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The address pattern and the placeholder addresses the campaign rejects.
EMAIL_PATTERN = r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
PLACEHOLDER_PATTERNS = {
    "none_user": r"^none@",
    "none_domain": r"@none\.com",
    "no_email": r"noemail",
}
WAVE_DATE_PATTERN = r"[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{1,2}"


def pad_key(value: Column, width: int) -> Column:
    """Zero-pad on the left; longer values stay whole."""
    text = value.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def account_key(division: Column, account: Column) -> Column:
    """``DDD-NNNNNNN``, NULL when either part is NULL."""
    return F.concat(pad_key(division, 3), F.lit("-"), pad_key(account, 7))


def base36(number: Column, width: int = 4) -> Column:
    return pad_key(F.conv(number.cast("string"), 10, 36), width)


def clean_email(raw: Column) -> Column:
    """Drop what follows ``.com``, then spaces, commas, quotes and slashes."""
    return F.translate(F.regexp_replace(raw, r"(?s)\.com.*", ".com"), " ,'/", "")


def email_reject_reason(cleaned: Column, own_domain: str) -> Column:
    """First matching reason, NULL for a usable address."""
    lowered = F.lower(cleaned)
    reason = F.when(~F.coalesce(cleaned.rlike(EMAIL_PATTERN), F.lit(False)), "not_an_address")
    for name, pattern in PLACEHOLDER_PATTERNS.items():
        reason = reason.when(lowered.rlike(pattern), name)
    return reason.when(lowered.contains("@" + own_domain.lower()), "own_domain")


def occurrences(text: Column, word: str) -> Column:
    """Non-overlapping, case-sensitive occurrences of ``word`` inside ``text``."""
    if not word:
        raise ValueError("word must not be empty")
    removed = F.length(text) - F.length(F.replace(text, F.lit(word), F.lit("")))
    return (removed / F.lit(len(word))).cast("long")


def same_text(left: Column, right: Column) -> Column:
    """Comparison as the warehouse collation makes it: case and outer blanks do not count."""
    return F.upper(F.trim(left)) == F.upper(F.trim(right))


def code_in(code: Column, codes: list[str] | tuple[str, ...]) -> Column:
    return F.upper(F.trim(code)).isin([c.upper() for c in codes])


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def wave_of_file(name: Column, start: int = 23, length: int = 2) -> Column:
    return F.substring(name, start, length)


def wave_date_of_file(name: Column) -> Column:
    return F.regexp_extract(name, WAVE_DATE_PATTERN, 0)


def postal_parts(postal: Column) -> tuple[Column, Column]:
    parts = F.split(postal, "-")
    return F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))
