"""HTML as marked-up strings: one pass per concern, no parser and no Python in the tasks.

Control characters \\x01-\\x05 serve as markers; where a page has them itself it is guarded first and unguarded at the end:

    \\x01H heading start   \\x01P paragraph   \\x01C code block
    \\x02 fences around raw text while it is being protected, later in front of each tag name, and \\x03 behind it
    \\x04 stands for '<' and \\x05 for '&' inside raw text
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.entities import decode_guarded, mask
from millrace.functions.htmltree import KINDS, TAGS, text_ranges
from millrace.functions.let import bind
from millrace.functions.text import guard, unguard, unix_lines

# The rest of a tag: quoted attribute values may hold '>'. Possessive loops run without recursion.
_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_AFTER_NAME = rf"(?:>|[\s/]{_REST})"

# Elements whose content is text, never markup.
RAW_TEXT = ("script", "style", "noscript", "iframe", "noembed", "noframes", "xmp", "textarea", "title")

# Every pattern starts with a plain '<', so that text between tags is passed over quickly. Each ends with
# the alternative of any tag, which takes an unclosed one up to the end of the page: a match always moves on, and no
# part of a broken page is scanned from many starts.
_ANY = rf"<(?:/?[a-z](?:{_REST}|[^>]*(?:>|\z))|[!?/][^>]*(?:>|\z))"
_TAG = rf"(?is){_ANY}"
_RAW = r"(?is)<(?:!--.*?(?:--!?>|\z)" + "".join(
    rf"|{name}{_AFTER_NAME}(.*?)(?:</{name}(?:>|[\s/][^>]*>?)|\z)" for name in RAW_TEXT
) + rf")|({_ANY})"
# Of any other tag there is an empty piece and the tag behind it.
_RAW_FENCED = "\x02" + "".join(f"${i + 1}" for i in range(len(RAW_TEXT))) + f"\x02${len(RAW_TEXT) + 1}"
# Tags that make the tree; of any other there is an empty name.
_NAMED = rf"(?is)<(/?(?:{'|'.join(sorted(TAGS, key=len, reverse=True))})){_AFTER_NAME}|{_ANY}"
_STANDARDS = "\x01"
_DOCTYPE = r"(?is)\A\s*+<!doctype\s++html"
_ANCHOR = rf"""(?is)<a[\s/]((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|{_ANY}"""
_ATTRIBUTE = r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?"""


def _fenced(text: Column, protect) -> Column:
    """Apply `protect` to every second \\x02-separated piece."""
    pieces = F.transform(
        F.split(text, "\x02", -1), lambda s, i: F.when(i % 2 == 1, protect(s)).otherwise(s)
    )
    return F.array_join(pieces, "")


def protect_raw_text(html: Column) -> Column:
    """Drop comments and the tags of raw-text elements; keep that text safe from later passes. The result is guarded."""
    return _fenced(F.regexp_replace(guard(unix_lines(html)), _RAW, _RAW_FENCED), mask)


def mark_blocks(html: Column) -> Column:
    """Headings, paragraphs and code blocks of a page in the order in which they begin, each behind its marker.

    References are decoded; the text is guarded. A heading or paragraph has all text inside of it, also that of blocks
    which come again on their own.
    """
    # What is in front of the first tag is in no element: it says whether the page has a doctype instead.
    mode = F.when(html.rlike(_DOCTYPE), _STANDARDS).otherwise("")
    named = F.concat(mode, F.regexp_replace(protect_raw_text(html), _NAMED, "\x02$1\x03"))
    pieces = F.split(decode_guarded(F.replace(named, F.lit("\x02\x03"), F.lit(""))), "\x02", -1)

    def parts(pieces: Column) -> Column:
        tags = F.transform(F.slice(pieces, 2, F.size(pieces)), lambda p: F.lower(F.substring_index(p, "\x03", 1)))
        texts = F.transform(F.slice(pieces, 2, F.size(pieces)), lambda p: F.substring_index(p, "\x03", -1))
        return F.struct(tags.alias("tags"), texts.alias("texts"), F.get(pieces, F.lit(0)).startswith(_STANDARDS).alias("standards"))

    def marked(tags: Column, texts: Column, standards: Column) -> Column:
        ranges = text_ranges(tags, standards)
        return F.array_join(F.transform(ranges, lambda r: F.concat(_marker(r["kind"]), F.array_join(F.slice(texts, r["start"] + 1, r["end"] - r["start"]), ""))), "")

    return bind(bind(pieces, parts), lambda p: marked(p["tags"], p["texts"], p["standards"]))


def _marker(kind: Column) -> Column:
    first, *others = KINDS.items()
    found = F.when(kind == first[0], f"\x01{first[1]}")
    for name, letter in others:
        found = found.when(kind == name, f"\x01{letter}")
    return found


def anchor_hrefs(html: Column) -> Column:
    """Every `href` of an `<a>` element, in document order."""
    # Other tags give an empty string.
    tags = F.filter(F.regexp_extract_all(protect_raw_text(html), F.lit(_ANCHOR), F.lit(1)), lambda t: t != "")

    def hrefs(attributes: Column) -> Column:
        names = F.regexp_extract_all(attributes, F.lit(_ATTRIBUTE), F.lit(1))
        values = F.regexp_extract_all(attributes, F.lit(_ATTRIBUTE), F.lit(2))
        named = F.zip_with(names, values, lambda n, v: F.when(F.lower(n) == "href", v))
        return F.filter(named, lambda v: v.isNotNull())

    def plain(value: Column) -> Column:
        return unguard(decode_guarded(F.regexp_replace(value, r"""^["']|["']$""", ""), in_attribute=True))

    return F.transform(F.flatten(F.transform(tags, hrefs)), plain)
