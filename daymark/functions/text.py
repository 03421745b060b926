"""Text of captured table cells."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Named references by the standard library's HTML table, those of one code point, and
# the numbers 128 to 159, which HTML reads as the characters of code page 1252.
NAMED = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}
C1_CODES = {
    code: bytes([code]).decode("cp1252") for code in range(128, 160) if code not in (129, 141, 143, 144, 157)
}
REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _literal_map(values: Mapping) -> Column:
    return F.create_map(*[F.lit(part) for pair in values.items() for part in pair])


def _character(code: Column) -> Column:
    """The character of a code point; the replacement character where there is none."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    utf32 = F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(F.lit(0xFFFD))), 8, "0"))
    return F.coalesce(
        F.try_element_at(_literal_map(C1_CODES), code.cast("int")), F.decode(utf32, "UTF-32")
    )


def decode_references(text: Column) -> Column:
    """Character references, named or numbered, become their characters, each once.

    What is no reference, or one of an unknown name, stays as it is.
    """

    def decoded(part: Column) -> Column:
        return let(F.regexp_extract(part, REFERENCE, 1), lambda name: replaced(part, name))

    def replaced(part: Column, name: Column) -> Column:
        rest = F.substr(part, F.char_length(name) + F.lit(2))
        number = F.when(
            F.lower(F.substr(name, F.lit(2), F.lit(1))) == "x",
            F.conv(F.substr(name, F.lit(3)), 16, 10),
        ).otherwise(F.substr(name, F.lit(2)))
        char = F.when(
            name.startswith("#"), let(number.try_cast("bigint"), _character)
        ).otherwise(F.try_element_at(_literal_map(NAMED), name))
        return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), part))

    def joined(parts: Column) -> Column:
        # The first part has no "&" before it.
        others = F.transform(parts, lambda part, i: F.when(i == 0, part).otherwise(decoded(part)))
        return F.array_join(others, "")

    return let(F.split(text, "&"), joined)


def strip(col: Column | str) -> Column:
    """Remove whitespace of every kind from both ends (``trim`` removes only spaces)."""
    return F.btrim(col, F.lit(WHITESPACE))


def cell_text(markup: Column | str) -> Column:
    """Text of a flat HTML cell: white space collapsed, tags dropped, entities decoded."""
    markup = F.col(markup) if isinstance(markup, str) else markup
    # Single spaces are not matched, and most cells have neither tags nor entities.
    text = F.regexp_replace(markup, r"[\t\r\n\f][ \t\r\n\f]*| [ \t\r\n\f]+", " ")
    lines = F.regexp_replace(text, r"(?i) ?<br\s*/?> ?", "\n")
    text = F.when(markup.contains("<"), F.regexp_replace(lines, r"<[^>]*>", "")).otherwise(text)
    return strip(
        F.when(markup.contains("&"), let(text, decode_references)).otherwise(text)
    )
