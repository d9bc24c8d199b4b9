"""The tree of a page, as far as headings, paragraphs and code blocks need it: a stack folded over the tags.

The state is the stack of open elements, innermost first. A tag closes what the rules of HTML let it close, then opens its
own element. Each heading, paragraph and code block that is closed leaves its kind and the numbers of the tags
between which its text lies. Inline elements play no part.

Fixed values: element classes and scopes, after the public HTML standard.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.let import bind

# Elements whose start closes an open paragraph, and whose end closes what is open inside them.
BLOCKS = (
    "address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "header", "hgroup", "hr", "li", "listing", "main",
    "menu", "nav", "ol", "search", "section", "summary", "ul",
)
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
TABLE_PARTS = ("caption", "tbody", "td", "tfoot", "th", "thead", "tr")
# Paragraphs outside of these are not closed from inside of them.
OTHERS = ("applet", "button", "marquee", "object", "table", "template")
TAGS = (*BLOCKS, *HEADINGS, *TABLE_PARTS, *OTHERS, "p", "pre")

#: Elements nested deeper are not opened, as in browsers.
MAX_DEPTH = 512
#: Tags folded before their results are put away: appending to a result copies it.
_CHUNK = 100

_CLASSES = {
    "heading": HEADINGS, "cell": ("td", "th"), "rows": ("tbody", "thead", "tfoot"), "term": ("dd", "dt"),
    "object": ("applet", "marquee", "object", "template"),
}
_SCOPE = ("table", "cell", "caption", "object")
_BUTTON_SCOPE = (*_SCOPE, "button")
_LIST_SCOPE = (*_SCOPE, "ol", "ul")
#: Of these kinds each closed element leaves a range; `heading` for the first three levels.
KINDS = {"heading": "H", "p": "P", "pre": "C"}

_RANGE = "struct<start:int,kind:string,end:int>"
_STATE = f"struct<stack:array<string>,starts:array<int>,found:array<{_RANGE}>>"


def _class_of(name: Column) -> Column:
    kind = F.when(name.isin("p", "div", "li", "ul"), name)
    for k, names in _CLASSES.items():
        kind = kind.when(name.isin(*names), k)
    return kind.otherwise(name)


def _at(stack: Column, kind: str | Column) -> Column:
    return F.array_position(stack, kind).cast("int")


def _in_scope(stack: Column, kind: str | Column, scope: tuple[str, ...]) -> Column:
    """Place of the innermost element of a kind, 0 if there is none or an element of the scope lies in front of it."""
    return bind(
        _at(stack, kind),
        lambda at: F.when(
            (at > 0) & ~F.exists(F.slice(stack, 1, F.greatest(at - 1, F.lit(0))), lambda e: e.isin(*scope)), at
        ).otherwise(0),
    )


def _below(stack: Column, *kinds: str) -> Column:
    """Number of elements in front of the innermost one of some kinds, where there is one."""
    places = [F.nullif(_at(stack, k), F.lit(0)) for k in kinds]
    return (F.least(*places) if len(places) > 1 else places[0]) - 1


def _closed_by_end(stack: Column, kind: Column) -> Column:
    in_table = bind(_at(stack, kind), lambda at: F.when((at > 0) & (at <= F.coalesce(_below(stack, "table"), F.lit(0))), at).otherwise(0))
    return (
        F.when(kind == "p", _in_scope(stack, "p", _BUTTON_SCOPE))
        .when(kind == "table", _at(stack, "table"))
        .when(kind.isin("cell", "tr", "rows", "caption"), in_table)
        .when(kind == "li", _in_scope(stack, "li", _LIST_SCOPE))
        .otherwise(_in_scope(stack, kind, _SCOPE))
    )


def _closed_by_start(stack: Column, kind: Column, standards: Column) -> Column:
    """How many elements a start tag closes; NULL for a table part outside of tables, which is ignored."""

    def paragraph(rest: Column) -> Column:
        return _in_scope(rest, "p", _BUTTON_SCOPE)

    def item(which: str) -> Column:
        # Only these may lie between an item and the next one.
        def own(at: Column) -> Column:
            return F.when((at > 0) & F.forall(F.slice(stack, 1, F.greatest(at - 1, F.lit(0))), lambda e: e.isin("address", "div", "p")), at).otherwise(0)

        return bind(bind(_at(stack, which), own), lambda n: n + paragraph(F.slice(stack, n + 1, F.size(stack))))

    def heading(n: Column) -> Column:
        return n + F.when(F.get(stack, n) == "heading", 1).otherwise(0)

    return (
        F.when(kind.isin("rows", "caption"), _below(stack, "table"))
        .when(kind == "tr", _below(stack, "rows", "table"))
        .when(kind == "cell", F.when(_at(stack, "table") > 0, _below(stack, "tr", "rows", "table")))
        .when(kind == "li", item("li"))
        .when(kind == "term", item("term"))
        .when(kind == "heading", bind(paragraph(stack), heading))
        .when(kind == "button", _in_scope(stack, "button", _SCOPE))
        .when((kind == "object") | ((kind == "table") & ~standards), 0)
        .otherwise(paragraph(stack))
    )


def _ranges(stack: Column, starts: Column, n: Column, at: Column) -> Column:
    """What closing the innermost `n` elements at a tag leaves."""
    every = F.zip_with(
        F.slice(stack, 1, n), F.slice(starts, 1, n),
        lambda e, s: F.struct(s.alias("start"), e.alias("kind"), at.alias("end")),
    )
    return F.filter(every, lambda r: r["start"] >= 0)


def _step(state: Column, tag: Column, at: Column, standards: Column) -> Column:
    stack, starts = state["stack"], state["starts"]
    ends, name = tag["ends"], tag["name"]

    def moved(kind: Column, closed: Column) -> Column:
        n = F.coalesce(closed, F.lit(0))
        opened = ~ends & closed.isNotNull() & (kind != "hr") & (F.size(stack) < MAX_DEPTH)
        shown = kind.isin(*KINDS) & ~name.isin(*HEADINGS[3:]) & ~F.array_contains(stack, "pre")
        start = F.when(shown, at).otherwise(-1)

        def rest(of: Column, first: Column) -> Column:
            kept = F.when(n > 0, F.slice(of, n + 1, F.size(of))).otherwise(of)
            return F.when(opened, F.concat(F.array(first), kept)).otherwise(kept)

        found = F.when(n > 0, F.concat(state["found"], _ranges(stack, starts, n, at))).otherwise(state["found"])
        return F.struct(rest(stack, kind).alias("stack"), rest(starts, start).alias("starts"), found.alias("found"))

    def closed(kind: Column) -> Column:
        n = F.when(ends, _closed_by_end(stack, kind)).otherwise(_closed_by_start(stack, kind, standards))
        return bind(n, lambda c: moved(kind, c))

    return closed(tag["kind"])


def _tag(text: Column) -> Column:
    """What the steps want to know of a tag, found out once."""
    ends = text.startswith("/")
    name = F.when(ends, F.substr(text, F.lit(2))).otherwise(text)
    return bind(name, lambda n: F.struct(ends.alias("ends"), n.alias("name"), _class_of(n).alias("kind")))


def text_ranges(tags: Column, standards: Column) -> Column:
    """Ranges of headings, paragraphs and code blocks, by start: the text behind tag `start` up to tag `end`.

    `tags` are the names in lower case, with `/` in front of end tags; `standards`: whether tables close paragraphs.
    """
    none = F.array().cast(f"array<{_RANGE}>")
    empty = F.struct(F.array().cast("array<string>").alias("stack"), F.array().cast("array<int>").alias("starts"), none.alias("found")).cast(_STATE)
    kind = f"struct<open:{_STATE},done:array<array<{_RANGE}>>>"

    def chunk(state: Column, c: Column) -> Column:
        numbers = F.sequence(c * _CHUNK, F.least((c + 1) * _CHUNK, F.size(tags)) - 1)
        after = F.aggregate(numbers, state["open"], lambda s, i: bind(_tag(F.get(tags, i)), lambda t: _step(s, t, i, standards)))
        return bind(
            after,
            lambda s: F.struct(
                F.struct(s["stack"].alias("stack"), s["starts"].alias("starts"), none.alias("found")).alias("open"),
                F.concat(state["done"], F.array(s["found"])).alias("done"),
            ),
        )

    def finish(state: Column) -> Column:
        left = state["open"]
        last = _ranges(left["stack"], left["starts"], F.size(left["stack"]), F.size(tags))
        return F.array_sort(F.concat(F.flatten(state["done"]), last))

    start = F.struct(empty.alias("open"), F.array().cast(f"array<array<{_RANGE}>>").alias("done")).cast(kind)
    chunks = F.sequence(F.lit(0), F.floor((F.size(tags) - 1) / _CHUNK).cast("int"))
    return F.when(F.size(tags) > 0, F.aggregate(chunks, start, chunk, finish)).otherwise(none)
