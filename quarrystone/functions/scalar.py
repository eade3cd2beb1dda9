"""Scalar expressions on built-in functions: names and keys, numbers, digests, dates."""

from __future__ import annotations

import hashlib
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abbreviations at the start of a programme name, in order.
ABBREVIATIONS = [
    (r"^ING\.\s+", "INGENIERIA "),
    (r"^ADM\.\s+", "ADMINISTRACION "),
    (r"^EDUC\.\s+", "EDUCACION "),
    (r"^TEC\.\s+", "TECNOLOGIA "),
    (r"^MED\.\s+", "MEDICINA "),
    (r"^ARQ\.\s+", "ARQUITECTURA "),
]
# Numerals that are no site, and the form of a trailing site.
ROMAN = ("I", "II", "III", "IV", "V")
SITE = r"-\s*([A-ZÑÁÉÍÓÚ][A-ZÑÁÉÍÓÚ ]{2,})\s*$"


def _fold_table() -> tuple[str, str]:
    """Letters of the Latin blocks whose compatibility form has one ASCII character, and that."""
    pairs = []
    for code in range(0xA0, 0x250):
        plain = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            pairs.append((chr(code), plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_FROM, _TO = _fold_table()


def _mark_table() -> tuple[str, str]:
    """Letters that lose a combining mark, and what is left."""
    pairs = []
    for code in range(0xC0, 0x250):
        left = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(left) == 1 and left != chr(code):
            pairs.append((chr(code), left))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_MARKED, _BARE = _mark_table()


def ascii_fold(c: Column) -> Column:
    """Letters without accents; anything else beyond ASCII goes."""
    return F.regexp_replace(F.translate(c, _FROM, _TO), r"[^\x00-\x7F]", "")


def strip_marks(c: Column) -> Column:
    """Letters without combining marks; other letters and signs stay."""
    return F.regexp_replace(F.translate(c, _MARKED, _BARE), r"\p{Mn}", "")


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean_program(c: Column) -> Column:
    """H1: folded, without plan version and trailing score, upper case, abbreviations spelt out."""
    text = ascii_fold(F.coalesce(c, F.lit("")))
    text = F.regexp_replace(text, r"\(V\s*\d*\)?", "")
    text = F.regexp_replace(text, r"\s+\d+[.,]\d+\s*$", "")
    text = collapse(F.upper(text))
    return reduce(lambda t, rule: F.regexp_replace(t, *rule), ABBREVIATIONS, text)


def catalogue_name(c: Column) -> Column:
    """H2: folded, upper case, signs to spaces, one known alias."""
    text = collapse(F.regexp_replace(F.upper(ascii_fold(c)), r"[^A-Za-z0-9 ]", " "))
    return F.replace(text, F.lit("INGENIERIA DE SISTEMAS Y "), F.lit("INGENIERIA DE SISTEMAS "))


def parser_name(c: Column) -> Column:
    """H3: folded, single spaces, upper case."""
    return F.upper(collapse(ascii_fold(c)))


def alnum_key(c: Column) -> Column:
    """H4: folded, upper case, letters and digits only."""
    return F.regexp_replace(F.upper(ascii_fold(c)), "[^A-Z0-9]", "")


def program_key(c: Column) -> Column:
    """H5: without combining marks, upper case, single spaces; signs and other letters stay."""
    return collapse(F.upper(strip_marks(F.coalesce(c, F.lit("")))))


def trailing_site(c: Column) -> Column:
    """H6: what follows the last dash of a process line, unless it is a numeral."""
    site = F.trim(F.regexp_extract(c, SITE, 1))
    return F.when((site != "") & ~site.isin(*ROMAN), site)


def leading_rank(c: Column) -> tuple[Column, Column]:
    """H7: rank and rest of a cell that begins with a number; null where it does not."""
    form = r"^(\d+)\s+(\S.*)$"
    hit = c.rlike(form)
    return F.when(hit, F.regexp_extract(c, form, 1)), F.when(hit, F.regexp_extract(c, form, 2))


def first_decimal(c: Column) -> Column:
    """H8: the first decimal number in a text."""
    return F.nullif(F.regexp_extract(c, r"(\d+\.\d+)", 1), F.lit("")).cast("double")


def safe_double(c: Column) -> Column:
    """B2: a number, or null where the text is none (suffixes of other languages included)."""
    text = F.trim(c)
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))


def safe_int(c: Column) -> Column:
    """A whole number by way of a double, cut towards zero."""
    return safe_double(c).cast("long")


def half_even(c: Column, digits: int) -> Column:
    """H9: rounding of ties to even, as published figures have it."""
    return F.bround(c, digits)


def bin_floor(c: Column, width: int) -> Column:
    """Lower edge of the bin; negative numbers round down."""
    return (F.floor(c / width) * width).cast("long")


def hmac_sha256(c: Column, secret: bytes, digits: int = 16) -> Column:
    """Keyed digest of all-digit codes, cut to ``digits`` hex digits; null for other codes.

    Composed from ``sha2``: the padded keys are literals.
    """
    if not secret:
        raise ValueError("pseudonyms need a secret")
    key = (hashlib.sha256(secret).digest() if len(secret) > 64 else secret).ljust(64, b"\0")
    pad = lambda x: F.unhex(F.lit(bytes(b ^ x for b in key).hex()))
    inner = F.sha2(F.concat(pad(0x36), F.encode(c, "UTF-8")), 256)
    outer = F.sha2(F.concat(pad(0x5C), F.unhex(inner)), 256)
    return F.when(c.rlike(r"^\d+$"), F.substring(outer, 1, digits))


def content_id(c: Column, digits: int = 16) -> Column:
    """Shortened SHA-256 of content."""
    return F.substring(F.sha2(c, 256), 1, digits)


def exam_date(c: Column) -> Column:
    """A date written day/month/year, null where it is none."""
    return F.when(F.length(c) == 10, F.to_date(F.try_to_timestamp(c, F.lit("dd/MM/yyyy"))))


def base_name(c: Column) -> Column:
    """Last part of a path or address, percent signs decoded."""
    return F.regexp_extract(F.try_url_decode(c), r"([^/]*)$", 1)


def joined(*parts: Column) -> Column:
    """Parts with a bar between."""
    return F.concat_ws("|", *parts)


def split_once(c: Column) -> Column:
    return F.split(c, r"\|", 2)


def stride_sample(values: Column, most: int = 40) -> Column:
    """Of a sorted array every ``max(1, n div most)``-th value, ``most`` of them."""
    step = F.greatest(F.lit(1), F.floor(F.size(values) / most)).cast("int")
    return F.slice(F.filter(values, lambda _, i: i % step == 0), 1, most)


def thousands(c: Column) -> Column:
    """A count with separators, a dash for null."""
    return F.coalesce(F.format_number(c, 0), F.lit("—"))


def shorten(c: Column, most: int) -> Column:
    return F.when(F.char_length(c) > most, F.concat(F.substring(c, 1, most - 1), F.lit("…"))).otherwise(c)


def csv_field(c: Column) -> Column:
    """A field of the exported table, quoted where it has to be."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(text.rlike('[",\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)
