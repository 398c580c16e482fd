"""Text expressions: titles, lists, words and HTML."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide what a title, word or sign is.
TITLE_YEAR = r"^(.+)\((\d{4})\)$"
TITLE_YEAR_TRIMMED = r"^(.*?)\s*\((\d{4})\)\s*$"
WORD_GAPS = r"[\s\p{Punct}—…”„]+"
UNICODE_BLANKS = r"(?U)[\s\x1c-\x1f]+"
WORD_2PLUS = r"[\p{L}\p{N}_]{2,}"
HTML_MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<script\b.*?(?:</script\s*>|\z)"
    r"|<style\b.*?(?:</style\s*>|\z)"
    # possessive: any number of quoted attributes without recursion
    r"""|</?[a-z][^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*+>"""
    r"|<[/a-z!?][^>]*>"
)
HTML_SIGNS = r"""[#",!?;-<>/\\*&-]"""
HTML_BRACKETED = r"\[[^\]]*\]"
HTML_OTHER_SIGNS = r"[:.+=()–©°′″•↑—]"
HTML_NUMBERS = r"(?U)\d+\.?\d*"
# One reference: two numbers of a surrogate pair, one number, or a name.
HTML_REFERENCE = (
    r"&#(?:5529[6-9]|55[3-9]\d\d|56[0-2]\d\d|563[01]\d);&#(?:563[2-9]\d|56[4-9]\d\d|57[0-2]\d\d|573[0-3]\d|5734[0-3]);"
    r"|&#[xX][dD][89abAB][0-9a-fA-F]{2};&#[xX][dD][c-fC-F][0-9a-fA-F]{2};"
    r"|&#[0-9]+;|&#[xX][0-9a-fA-F]+;|&[a-zA-Z][a-zA-Z0-9]*;"
)
# The names of the HTML standard, as Python's library has them.
HTML_NAMES = {name[:-1]: sign for name, sign in html5.items() if name.endswith(";")}
# What numbers 128 to 159 stand for in HTML: Windows-1252 where that has a sign.
WINDOWS_SIGNS = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))
# Stands for a decoded & until all references are replaced; a sign that no text may hold.
AMPERSAND = "\uffff"


def strict_title(title: Column) -> Column:
    """Text before ``(yyyy)``; keeps a trailing blank, empty when there is no year."""
    return F.regexp_extract(title, TITLE_YEAR, 1)


def strict_year(title: Column) -> Column:
    """The year at the very end of the title; empty when something follows it."""
    return F.regexp_extract(title, TITLE_YEAR, 2)


def clean_title(title: Column) -> Column:
    """Title without year and blanks around it; the raw title when it has no year."""
    parsed = F.regexp_extract(title, TITLE_YEAR_TRIMMED, 1)
    return F.when(parsed == "", title).otherwise(parsed)


def pipe_list(text: Column) -> Column:
    return F.split(text, r"\|")


def blank_count_words(text: Column) -> Column:
    """Number of pieces between single blanks: runs of blanks count, '' gives 1."""
    return F.size(F.split(text, " "))


def words(text: Column) -> Column:
    """Words between runs of (Unicode) blanks, no empty ones."""
    return F.array_remove(F.split(text, UNICODE_BLANKS), "")


def tokens(text: Column) -> Column:
    """Lower-cased words between blanks and punctuation."""
    return F.array_remove(F.split(F.lower(text), WORD_GAPS), "")


def tokens_2plus(text: Column) -> Column:
    """Lower-cased letter/digit/underscore words of at least two characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_2PLUS), F.lit(0))


def _sign(code: Column) -> Column:
    """The character of a code point; U+FFFD for what is none, Windows-1252 where HTML reads numbers so."""
    utf = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    old = F.substring(F.lit(WINDOWS_SIGNS), (code - 0x7F).cast("int"), 1)
    bad = code.isNull() | (code <= 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    return F.when(bad, F.lit("\ufffd")).when(code.between(0x80, 0x9F), old).otherwise(utf)


def _decoded(reference: Column) -> Column:
    """What one reference stands for; unknown names stand for themselves."""
    numbers = F.regexp_extract_all(reference, F.lit("&#([0-9]+|[xX][0-9a-fA-F]+);"), F.lit(1))

    def value(text: Column) -> Column:
        # Ten digits exceed every code point; longer ones are cut so that they stay numbers.
        digits = F.regexp_replace(text, "^[xX]?0*", "")
        number = F.when(text.rlike("^[xX]"), F.conv(F.substring(digits, 1, 8), 16, 10)).otherwise(F.substring(digits, 1, 10))
        return F.coalesce(number.try_cast("bigint"), F.lit(0))

    one, two = value(F.get(numbers, F.lit(0))), value(F.get(numbers, F.lit(1)))
    pair = (one - 0xD800) * 0x400 + two - 0xDC00 + 0x10000
    names = F.map_from_arrays(F.lit(list(HTML_NAMES)), F.lit(list(HTML_NAMES.values())))
    named = F.coalesce(F.try_element_at(names, F.substring_index(F.substring(reference, 2, 100), ";", 1)), reference)
    sign = F.when(F.size(numbers) == 2, _sign(pair)).when(F.size(numbers) == 1, _sign(one)).otherwise(named)
    return F.when(sign == "&", F.lit(AMPERSAND)).otherwise(sign)


def decode_entities(text: Column) -> Column:
    """All named and numeric character references, decoded once: what comes out is not decoded again."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(HTML_REFERENCE), F.lit(0)))
    # The longest first: a pair goes before its halves.
    ordered = F.reverse(F.array_sort(F.transform(found, lambda r: F.struct(F.length(r).alias("n"), r.alias("r")))))
    out = F.aggregate(ordered, text, lambda done, item: F.replace(done, item["r"], _decoded(item["r"])))
    return F.replace(out, F.lit(AMPERSAND), F.lit("&"))


def html_text(html: Column) -> Column:
    """Text nodes joined by blanks; scripts, styles, comments and tags are dropped."""
    return decode_entities(F.regexp_replace(html, HTML_MARKUP, " "))


def html_words(html: Column) -> Column:
    """Words of a page after removing signs, bracketed notes and numbers."""
    text = html_text(html)
    for pattern in (HTML_SIGNS, HTML_BRACKETED, HTML_OTHER_SIGNS, HTML_NUMBERS):
        text = F.regexp_replace(text, pattern, " ")
    return words(text)
