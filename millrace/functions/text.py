"""String expressions with byte-exact and Unicode-aware behaviour."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white-space characters that trimming removes.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r \x85\xa0 "
    "           "
    "    　"
)


def trim_space(text: Column) -> Column:
    """Cut Unicode white space from both ends."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def head_contains(text: Column, markers: Sequence[str], n_bytes: int) -> Column:
    """True when one of the ASCII `markers` lies wholly in the first `n_bytes` UTF-8 bytes."""
    # A cut inside a character is harmless here: the string is only searched.
    head = F.substring(text.cast("binary"), 1, n_bytes).cast("string")
    return reduce(or_, [F.contains(head, F.lit(m)) for m in markers])


def line_count(text: Column) -> Column:
    """Number of line feeds plus one."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def unix_lines(text: Column) -> Column:
    """CR LF and lone CR become LF."""
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


# Markers that expressions put into texts, and what stands for each of them where a text has it itself.
MARKERS = "\x01\x02\x03\x04\x05"
_ESCAPE = "\x06"
_ESCAPED = {_ESCAPE: f"{_ESCAPE}0", **{c: f"{_ESCAPE}{i + 1}" for i, c in enumerate(MARKERS)}}


def guard(text: Column) -> Column:
    """Free a text of marker characters, reversibly; strings that have none pass uncopied."""
    for c, stand_in in _ESCAPED.items():
        text = F.replace(text, F.lit(c), F.lit(stand_in))
    return text


def unguard(text: Column) -> Column:
    """Bring back what `guard` replaced."""
    for c, stand_in in reversed(_ESCAPED.items()):
        text = F.replace(text, F.lit(stand_in), F.lit(c))
    return text


def guarded_character(code: Column) -> Column:
    """What `guard` makes of the character with a number up to that of the escape; NULL for other numbers."""
    numbers = {ord(c): stand_in for c, stand_in in _ESCAPED.items()}
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in numbers.items() for x in pair)), code.cast("int"))
