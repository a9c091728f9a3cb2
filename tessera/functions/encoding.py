"""Code pages as expressions: decoding, and repair of text decoded by the wrong page.

A text file in UTF-8 that is read in a code page comes out with every byte
above 127 as a character of its own ("CURA├çAO"). The way back: put every
character's byte for it, and see whether the bytes are UTF-8. A page is a
256-character table, taken from the Python codec of its name; ``translate``
maps characters to those of Latin-1, whose code points are the bytes, so all
of it runs inside Spark for any page, also those ``encode`` does not know.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import _col, exact

#: Pages tried in this order where nothing says which.
PAGES = ("cp437", "cp850", "cp1252")

_HIGH = range(0x80, 0x100)


@lru_cache
def high_characters(page: str) -> tuple[str, str]:
    """Characters of bytes 128 to 255 in a page, and those of the same bytes in Latin-1; a byte without a character stands for itself."""
    return "".join(bytes([b]).decode(page, "ignore") or chr(b) for b in _HIGH), "".join(map(chr, _HIGH))


def _class(characters: str) -> str:
    """A regular-expression class of the characters and ASCII."""
    return "^[\\x00-\\x7F" + "".join(f"\\x{{{ord(c):x}}}" for c in characters) + "]*$"


def from_bytes(data, page: str) -> Column:
    """Text of bytes in a code page."""
    own, latin = high_characters(page)
    return F.translate(F.decode(_col(data), "ISO-8859-1"), latin, own)


def to_bytes(c, page: str) -> Column:
    """Bytes of text in a code page; null where it holds a character that the page lacks."""
    own, latin = high_characters(page)
    c = exact(c)
    # a character of Latin-1 that isn't one of the page's would pass for a byte
    return F.when(c.rlike(_class(own)), F.encode(F.translate(c, own, latin), "ISO-8859-1"))


def misread(c, page: str) -> Column:
    """What becomes of text whose UTF-8 bytes are read in a code page."""
    return from_bytes(exact(c).cast("binary"), page)


def utf8_of(c, page: str) -> Column:
    """The text that was read in a code page, if its bytes there are UTF-8 and not ASCII only; else null.

    Text read rightly is null: its high characters stand alone or in an order that
    UTF-8 has not (an accented letter between ASCII letters is no UTF-8 sequence).
    """
    back = to_bytes(c, page).cast("string")
    return F.when(exact(c).rlike("[^\\x00-\\x7F]") & F.is_valid_utf8(back), back)


def repair_text(c, pages: tuple = PAGES) -> Column:
    """The text as it was before it was read in one of ``pages`` (the first under whose bytes it is UTF-8); other text unchanged."""
    return F.coalesce(*[utf8_of(c, p) for p in pages], exact(c))


def plausible(c) -> Column:
    """Number of high characters that stand where such characters stand: small Latin letters beside small
    ASCII letters, capitals beside capitals, an apostrophe between letters, other quotes, dashes and the
    like not between them. The right page of a text gives most."""
    small, capital, sign = r"[\p{Ll}&&\p{IsLatin}]", r"[\p{Lu}&&\p{IsLatin}]", "[“”„–—…€«»]"
    letters = f"(?<=[a-z]){small}|{small}(?=[a-z])|(?<=[A-Z]){capital}(?![a-z])|{capital}(?=[A-Z])"
    signs = f"(?<=[A-Za-z])’(?=[A-Za-z])|(?<![A-Za-z]){sign}|{sign}(?![A-Za-z])"
    return F.regexp_count(exact(c), F.lit(rf"(?=[^\x00-\x7F])(?:{letters}|{signs})"))
