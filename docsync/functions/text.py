"""Column functions on text shared by the extractors and chunkers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that Unicode-aware \s and strip() take as white space. Java looks single ones below 256 up in one table, but tests the
# parts of a class one after the other; so those below 256 are listed alone, and the others stand behind the range that they lie in: two tests for most characters.
_NEAR = "\\u0009\\u000a\\u000b\\u000c\\u000d\\u001c\\u001d\\u001e\\u001f\\u0020\\u0085\\u00a0"
_FAR = "\\u1680-\\u3000&&[\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
WS = f"[[{_NEAR}][{_FAR}]]"
NOT_WS = f"[^[{_NEAR}][{_FAR}]]"
WS_CHARS = "".join(chr(i) for i in (*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def newlines(c: Column) -> Column:
    r"""``\r\n`` and ``\r`` as ``\n``."""
    return F.regexp_replace(c, r"\r\n?", "\n")


def utf8(content: Column) -> Column:
    """Binary content as text: invalid bytes become U+FFFD, line ends ``\\n``."""
    return newlines(F.make_valid_utf8(content.cast("string")))


def strip(c: Column) -> Column:
    """Without white space at both ends; linear in the length, whatever stands inside."""
    return F.btrim(c, F.lit(WS_CHARS))


def collapse(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def number_kept(texts: Column) -> Column:
    """An array of texts as an array of (paragraph_num, text): blank ones go, the others count from 1."""
    kept = F.filter(texts, lambda t: F.length(t) > 0)
    return F.transform(kept, lambda t, i: F.struct((i + 1).cast("int").alias("paragraph_num"), t.alias("text")))


def blank_line_blocks(c: Column) -> Column:
    """The texts between blank lines, with white space collapsed."""
    return F.transform(F.split(c, f"\n{WS}*\n+"), collapse)


def non_empty(c: Column) -> Column:
    """Null where the text is empty, so that concat_ws leaves it out."""
    return F.when(F.length(c) > 0, c)
