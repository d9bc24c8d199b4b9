"""HTML character references, decoded with built-in functions.

The name table comes from Python's standard library and enters the plan as one literal.
"""

from __future__ import annotations

import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.let import bind
from millrace.functions.text import guard, guarded_character, unguard

_REFERENCE = r"^(#[xX][0-9a-fA-F]+;?|#[0-9]+;?|[A-Za-z][A-Za-z0-9]*;)"


@lru_cache
def _names_json() -> str:
    by_initial: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        by_initial.setdefault(name[0], {})[name] = text
    return json.dumps(by_initial, ensure_ascii=False)


@lru_cache
def _windows_1252_json() -> str:
    """Numeric references to 0x80-0x9F mean Windows-1252 characters."""
    decoded = {n: bytes([n]).decode("cp1252", "ignore") for n in range(0x80, 0xA0)}
    return json.dumps({str(n): text for n, text in decoded.items() if text}, ensure_ascii=False)


@lru_cache
def _bare_names_pattern() -> str:
    names = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
    return "^(" + "|".join(names) + ")"


def _named(name: Column) -> Column:
    table = F.from_json(F.lit(_names_json()), "map<string, map<string, string>>")
    return F.try_element_at(F.try_element_at(table, F.substring(name, 1, 1)), name)


def _character(code: Column) -> Column:
    invalid = code.isNull() | (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    remapped = F.from_json(F.lit(_windows_1252_json()), "map<string, string>")
    utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
    return (
        F.when(invalid, F.lit("�"))
        .when(code <= 6, guarded_character(code))
        .otherwise(F.coalesce(F.try_element_at(remapped, code.cast("string")), F.decode(utf32, "UTF-32")))
    )


def _numeric(ref: Column) -> Column:
    is_hex = F.substring(ref, 2, 1).isin("x", "X")

    def code(digits: Column) -> Column:
        number = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
        # No character has a longer number; conv and cast would fail on much longer ones.
        return F.when(F.char_length(digits) <= 8, number)

    return bind(bind(F.regexp_replace(ref, r"^#[xX]?0*(?=[0-9a-fA-F])|;$", ""), code), _character)


def _decode_piece(piece: Column, in_attribute: bool) -> Column:
    """`piece` is the text after an '&', `ref` the reference it starts with, if it has the full form."""
    text, ref = piece["text"], piece["ref"]
    known = F.when(ref.startswith("#"), _numeric(ref)).otherwise(_named(ref))
    full = F.when(ref != "", F.concat(known, F.substr(text, F.length(ref) + 1)))

    def without_semicolon(bare: Column) -> Column:
        rest = F.substr(text, F.length(bare) + 1)
        allowed = bare != ""
        if in_attribute:
            allowed = allowed & ~rest.rlike(r"^[=A-Za-z0-9]")
        return F.when(allowed, F.concat(_named(bare), rest))

    bare = bind(F.regexp_extract(text, _bare_names_pattern(), 1), without_semicolon)
    return F.coalesce(full, bare, F.concat(F.lit("&"), text))


# The commonest references. '&' and '<' stay masked until the rest is decoded.
_COMMON = {"&amp;": "\x05", "&lt;": "\x04", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\xa0"}
_MASKED = {"\x05": "&", "\x04": "<"}


def _swap(text: Column, pairs: dict[str, str]) -> Column:
    for old, new in pairs.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def mask(text: Column) -> Column:
    """Keep '&' and '<' from being read as markup; `decode_guarded` brings them back."""
    return _swap(text, {new: old for old, new in _MASKED.items()})


def decode_entities(text: Column, in_attribute: bool = False) -> Column:
    """Replace character references."""
    return unguard(decode_guarded(guard(text), in_attribute))


def decode_guarded(text: Column, in_attribute: bool = False) -> Column:
    """Replace character references in a guarded text, and unmask; the result is guarded, too."""
    pieces = F.transform(
        F.split(_swap(text, _COMMON), "&", -1),
        lambda s, i: F.when(i == 0, s).otherwise(
            bind(
                F.struct(s.alias("text"), F.regexp_extract(s, _REFERENCE, 1).alias("ref")),
                lambda p: _decode_piece(p, in_attribute),
            )
        ),
    )
    return _swap(F.array_join(pieces, ""), _MASKED)
