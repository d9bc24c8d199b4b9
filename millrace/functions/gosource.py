"""Go source text as lines, with multi-line literals and comments folded onto one line.

Function boundaries are read off the canonical layout: a declaration starts a line with `func ` and its
closing brace stands alone at the start of a line. Folding raw strings and block comments keeps their
content from being taken for either.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.let import bind
from millrace.functions.text import guard, trim_space, unguard, unix_lines

#: Stands for a line feed inside a raw string or block comment.
FOLD = "\x02"
_FENCE = "\x03"

# A run of plain text, then a token that can hide line starts or the start of such a token: raw string,
# block comment, line comment, string, rune, or a lone delimiter. Every match moves on, and possessive
# loops do not recurse, so the time is linear and long literals are safe.
_TOKENS = (
    r"""(?s)([^`"'/]*+)(`[^`]*+`|/\*.*?(?:\*/|\z)|//[^\n]*+|"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|[`"'/]|\z)"""
)


# A pair of brackets, up to three deep.
_PAIR = r"\(\)|\[\]|\{\}"
for _ in range(2):
    _PAIR = rf"\((?:{_PAIR})*+\)|\[(?:{_PAIR})*+\]|\{{(?:{_PAIR})*+\}}"
_UNCLOSED_COMMENT = rf"{_FENCE}/\*(?:(?!\*/)[^{_FENCE}])*+{_FENCE}"
_PACKAGE_FIRST = r"\A\s*+package\s++[\p{L}_][\p{L}\p{Nd}_]*+[ \t]*+(?:[;\n]|\z)"


def fold(source: Column) -> Column:
    """`folded`: the text with literals and comments on one line, guarded; `sound`: whether it can be a Go file."""
    text = F.ltrim(guard(unix_lines(source)), F.lit("\ufeff"))

    def parts(fenced: Column) -> Column:
        def of(pieces: Column) -> Column:
            folded = F.transform(pieces, lambda s, i: F.when(i % 2 == 1, F.replace(s, F.lit("\n"), F.lit(FOLD))).otherwise(s))
            code = F.array_join(F.filter(pieces, lambda _, i: i % 2 == 0), " ")
            return F.struct(F.array_join(folded, "").alias("folded"), (_literals_closed(fenced) & bind(code, _sound_code)).alias("sound"))

        return bind(F.split(fenced, _FENCE, -1), of)

    return bind(F.regexp_replace(text, _TOKENS, f"$1{_FENCE}$2{_FENCE}"), parts)


def _literals_closed(fenced: Column) -> Column:
    # A delimiter that is a token of its own opens what never ends.
    lone = [F.contains(fenced, F.lit(f"{_FENCE}{c}{_FENCE}")) for c in "`\"'"]
    return ~(lone[0] | lone[1] | lone[2] | fenced.rlike(_UNCLOSED_COMMENT))


def _sound_code(code: Column) -> Column:
    """Without literals and comments: the package clause comes first and brackets are balanced."""
    return code.rlike(_PACKAGE_FIRST) & bind(F.regexp_replace(code, r"[^(){}\[\]]++", ""), balanced)


def balanced(brackets: Column) -> Column:
    """Whether a text of brackets is balanced: pairs vanish from the inside, what is left goes over a stack."""
    rest = F.aggregate(
        F.sequence(F.lit(1), F.lit(4)), brackets, lambda b, _: F.when(b == "", b).otherwise(F.regexp_replace(b, _PAIR, ""))
    )

    def count(b: Column, c: str) -> Column:
        return F.octet_length(F.replace(b, F.lit(c), F.lit("")))

    def even(b: Column) -> Column:
        return (count(b, "(") == count(b, ")")) & (count(b, "[") == count(b, "]")) & (count(b, "{") == count(b, "}"))

    def step(stack: Column, c: Column) -> Column:
        match = F.translate(c, ")]}", "([{")
        popped = F.when(F.right(stack, F.lit(1)) == match, F.left(stack, F.length(stack) - 1)).otherwise("!")
        return F.when(stack == "!", stack).when(c.isin("(", "[", "{"), F.concat(stack, c)).otherwise(popped)

    def over_a_stack(b: Column) -> Column:
        # Behind the last character there is an empty piece.
        return F.aggregate(F.filter(F.split(b, ""), lambda c: c != ""), F.lit(""), step) == ""

    return bind(rest, lambda b: F.when(b == "", True).otherwise(even(b) & over_a_stack(b)))


def unfold(text: Column) -> Column:
    return unguard(F.replace(text, F.lit(FOLD), F.lit("\n")))


def package_name(folded: Column) -> Column:
    return F.regexp_extract(folded, r"(?m)^package[ \t]+([^\s;/]+)", 1)


def import_paths(folded: Column) -> Column:
    """All import paths of the file, in order."""
    first_other = F.regexp_instr(folded, F.lit(r"(?m)^(?:func|var|const|type)\b"))
    header = F.when(first_other > 0, F.substr(folded, F.lit(1), first_other - 1)).otherwise(folded)
    bare = F.regexp_replace(header, r"//[^\n]*|/\*[^\n]*?\*/", "")
    return F.transform(F.regexp_extract_all(bare, F.lit(r"""["`]([^"`\n]+)["`]"""), F.lit(1)), unguard)


# A line up to its trailing comment.
_CODE_PART = (
    r"""^(?:[^"'`/]++|"(?:[^"\\]|\\.)*+"|'(?:[^'\\]|\\.)*+'|`[^`]*+`|/\*.*?\*/|/(?![/*]))*+"""
)


def code_part(text: Column) -> Column:
    """First line without a trailing comment."""
    return F.rtrim(F.regexp_extract(F.substring_index(text, "\n", 1), _CODE_PART, 0), F.lit(" \t"))


def _declaration_text(chunk: Column) -> Column:
    """The function itself: one line, or the chunk cut at its closing brace."""

    def cut(code: Column) -> Column:
        close = F.regexp_instr(chunk, F.lit(r"(?m)^\}[ \t\r]*(?:/[/*].*)?$"))
        # Without canonical layout the last line that starts with a brace is the best guess.
        other = F.coalesce(F.nullif(F.regexp_extract(chunk, r"(?s)\A.*\n[ \t]*\}", 0), F.lit("")), code)
        to_brace = bind(close, lambda c: F.when(c > 0, F.substr(chunk, F.lit(1), c)).otherwise(other))
        return F.when(code.rlike(r"[{(\[,]$"), to_brace).otherwise(code)

    return bind(code_part(chunk), cut)


def _doc_text(doc_lines: Column) -> Column:
    """Comment text without markers and directives, blank runs collapsed, trimmed."""
    plain = F.transform(
        F.filter(doc_lines, lambda l: ~l.rlike(r"^//(?:line |extern |export |[a-z0-9]+:[a-z0-9])")),
        lambda l: F.when(
            l.startswith("//"), F.regexp_replace(l, r"^// ?", "")
        ).otherwise(F.replace(F.regexp_replace(l, r"^/\*|\*/\s*$", ""), F.lit(FOLD), F.lit("\n"))),
    )
    text = F.regexp_replace(F.array_join(plain, "\n"), r"(?m)[ \t\r]+$", "")
    return unguard(trim_space(F.regexp_replace(text, r"\n{3,}", "\n\n")))


def _is_comment(line: Column) -> Column:
    return line.startswith("//") | (line.startswith("/*") & F.rtrim(line).endswith("*/"))


def _comments_at_end(rest: Column, first: Column) -> Column:
    """The comment lines directly above what follows `rest`, leaving out the `first` lines."""
    # What follows starts a line, so the last piece is empty.
    lines = bind(F.split(rest, "\n", -1), lambda l: F.slice(l, first + 1, F.size(l) - 1 - first))

    def last_run(lines: Column) -> Column:
        code = F.transform(lines, lambda l, k: F.when(~_is_comment(l), k))
        return F.slice(lines, F.coalesce(F.array_max(code), F.lit(-1)) + 2, F.size(lines))

    return F.when(F.contains(rest, F.lit("\n")), bind(lines, last_run)).otherwise(F.array().cast("array<string>"))


def declarations(folded: Column) -> Column:
    """Array of (line_number, doc, declaration, body), one per line that starts a function.

    The file is cut before each such line. Of a piece, the declaration is what its layout says; the
    comment lines at its end are the doc of the next one. All texts are made here, per file, so that
    filters on the rows exploded from this array compute nothing again.
    """
    fenced = F.replace(folded, F.lit("\nfunc "), F.lit(f"\n{_FENCE}func "))

    def line_numbers(fenced: Column) -> Column:
        """Of every fence, in order: the place of its line among all lines, those inside literals included."""
        lines = F.split(F.replace(fenced, F.lit(FOLD), F.lit("\n")), "\n", -1)
        return F.array_compact(F.transform(lines, lambda line, i: F.when(line.startswith(_FENCE), i + 1)))

    def piece(chunk: Column, i: Column) -> Column:
        own = F.when(i > 0, _declaration_text(chunk)).otherwise("")
        # Behind a declaration the first piece of a line still belongs to it.
        tail = F.when(i > 0, 1).otherwise(0)
        return bind(
            own,
            lambda d: F.struct(
                d.alias("declaration"),
                _comments_at_end(F.substr(chunk, F.char_length(d) + 1), tail).alias("comments"),
            ),
        )

    def unit(piece: Column, comments: Column, line_number: Column) -> Column:
        documented = F.size(comments) > 0
        body = F.when(
            documented, F.concat(F.array_join(comments, "\n"), F.lit("\n"), piece["declaration"])
        ).otherwise(piece["declaration"])
        return F.struct(
            line_number.cast("bigint").alias("line_number"),
            F.when(documented, _doc_text(comments)).otherwise("").alias("doc"),
            unfold(piece["declaration"]).alias("declaration"),
            unfold(body).alias("body"),
        )

    def all_of(pieces: Column, numbers: Column) -> Column:
        return F.transform(
            F.slice(pieces, 2, F.size(pieces)),
            lambda p, i: unit(p, F.get(pieces, i)["comments"], F.get(numbers, i)),
        )

    return bind(
        fenced,
        lambda f: bind(
            line_numbers(f), lambda numbers: bind(F.transform(F.split(f, _FENCE, -1), piece), lambda p: all_of(p, numbers))
        ),
    )
