"""URL verdicts by rule lists held as Bloom filter cascades: exact membership without joining the pages.

A rule is `host/path`: it fits its host and all subdomains when the URL's path starts with the rule's. The
rules that can fit a URL are few: suffixes of its host with as many labels as some rule has, each with a
prefix of its path as long as some rule's of that many labels. These candidate keys of all URLs are the universe. A list's
cascade holds, level by level, a Bloom filter of the listed keys, one of the other keys of the universe that pass
it, one of the listed keys that pass that, and so on until nobody passes: on the universe the answer is exact.

Label counts and path lengths are a loop inside one expression, so lists of any variety work. Of the universe only keys
that pass the first filter are shuffled. Filters are built by a shuffle of (word, bits) rows, are one row each, and reach the
tasks as scalar subqueries. Their size is checked: a list that needs more than `max_words` words a level is joined instead.

Defined results: NULL or a URL without `://` has empty host and path, no rule, and the verdict of no rule
(`allow`). Of rules of equal length the one with the longer host wins; a key listed both ways blocks.
Repeated rows repeat their result, empty tables (pages or rules) work, very long URLs are read whole, other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.let import bind
from millrace.sources.scratch import written_table

BITS_PER_KEY, PROBES = 10, 5
#: 64-bit words of one filter that may be sent to every task (8 MB).
MAX_WORDS = 1 << 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.locate("://", url) + 3))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    host = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _rule_shapes(rules: DataFrame) -> DataFrame:
    """One row: the label counts of the rules, falling, each with the path lengths that occur with it."""
    host, path = F.split_part("rule", F.lit("/"), F.lit(1)), F.regexp_extract("rule", "^[^/]*(.*)$", 1)
    each = rules.select(F.size(F.split(host, r"\.", -1)).alias("n"), F.length(path).alias("m")).groupBy("n")
    lengths = each.agg(F.sort_array(F.collect_set("m")).alias("lengths"))
    return lengths.agg(F.sort_array(F.collect_list(F.struct("n", "lengths")), asc=False).alias("shapes"))


def candidates(host: Column, path: Column, shapes: Column) -> Column:
    """Keys of all rules that could fit, label counts falling, as an array."""
    # Bound together: an expression inside a lambda would run for each element.
    held = F.struct(F.split(host, r"\.", -1).alias("parts"), host.alias("host"), path.alias("path"), shapes.alias("shapes"))

    def of(url: Column, shape: Column) -> Column:
        tail = F.array_join(F.slice(url["parts"], F.size(url["parts"]) - shape["n"] + 1, shape["n"]), ".")
        lengths = F.filter(shape["lengths"], lambda m: m <= F.length(url["path"]))
        return bind(tail, lambda t: F.transform(lengths, lambda m: F.concat(t, F.left(url["path"], m))))

    def keys(url: Column) -> Column:
        able = F.filter(url["shapes"], lambda x: (x["n"] <= F.size(url["parts"])) & (url["host"] != ""))
        return F.flatten(F.transform(able, lambda x: of(url, x)))

    return bind(held, keys)


def _places(key: Column, level: int, words: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(64 * words)) for j in range(PROBES)]


class Cascade:
    """Filters of one list; after `refine` over a universe, `member` is exact for all its keys."""

    def __init__(self, listed: DataFrame, max_words: int = MAX_WORDS):
        """`listed` has distinct `key`."""
        self.listed, self.max_words = written_table(listed, "url-listed"), max_words
        self.levels: list[tuple[DataFrame, int]] = []
        self.too_large = False
        if n := self.listed.count():
            self._add(self.listed, n)

    def refine(self, passing: DataFrame) -> None:
        """`passing` has the distinct `key`s of the universe that pass the first level, and maybe others of it."""
        if not self.levels:
            return
        wrong = passing.where(self.passes(F.col("key"), 0)).join(self.listed, "key", "left_anti")
        other, current = self.listed, written_table(wrong, "url-passing")
        while not self.too_large and (n := current.count()):
            self._add(current, n)
            if not self.too_large:
                level = len(self.levels) - 1
                other, current = current, written_table(other.where(self.passes(F.col("key"), level)), "url-passing")

    def _add(self, keys: DataFrame, n: int) -> None:
        words = -(-n * BITS_PER_KEY // 64)
        if words > self.max_words:
            self.too_large = True
            return
        place = keys.select(F.explode(F.array(*_places(F.col("key"), len(self.levels), words))).alias("p"))
        bits = place.groupBy((F.col("p") / 64).cast("bigint").alias("w")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("p") % 64).cast("int"))).alias("b")
        )
        # Ordered by their number the words become one array; unset words are zero.
        dense = keys.sparkSession.range(words).join(bits, F.col("id") == F.col("w"), "left")
        row = dense.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("b", F.lit(0)).alias("b"))))["b"].alias("bits"))
        self.levels.append((written_table(row, "url-bits"), words))

    def passes(self, key: Column, level: int, bits: Column | None = None) -> Column:
        """`bits`: the level's, if the key is a name inside a lambda, where subqueries cannot stand."""
        row, words = self.levels[level]
        bits = row.scalar() if bits is None else bits
        hit = F.lit(True)
        for p in _places(key, level, words):
            word = F.get(bits, (p / 64).cast("int"))
            hit = hit & (F.call_function("shiftright", word, (p % 64).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return hit

    def member(self, key: Column, bits: list[Column]) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            answer = F.when(self.passes(key, level, bits[level]), answer).otherwise(F.lit(level % 2 == 1))
        return answer


def _over_keys(keyed: DataFrame, lists: list[Cascade], levels: int | None, body: Callable[[Column, list[list[Column]]], Column]) -> DataFrame:
    """`keyed` with `_keys` changed to `body(keys, bits of each list's levels)`.

    The filters are columns of one step that are read once each, so Spark puts the subqueries into the expression.
    """
    names = [[f"_bits{i}_{k}" for k in range(len(x.levels[:levels]))] for i, x in enumerate(lists)]
    rows = {name: row.scalar() for x, own in zip(lists, names) for name, (row, _) in zip(own, x.levels)}
    both = F.struct("_keys", *rows)
    bound = bind(both, lambda b: body(b["_keys"], [[b[name] for name in own] for own in names]))
    return (keyed.withColumns(rows) if rows else keyed).select("page_id", "host", "path", bound.alias("_keys"))


def _passing(keyed: DataFrame, lists: list[Cascade]) -> DataFrame:
    """Distinct candidate keys that pass the first level of any list: filtered in each row before the shuffle."""
    def any_of(key: Column, bits: list[list[Column]]) -> Column:
        hits = [x.passes(key, 0, own[0]) for x, own in zip(lists, bits) if x.levels]
        return reduce(Column.__or__, hits, F.lit(False))

    some = _over_keys(keyed, lists, 1, lambda keys, bits: F.filter(keys, lambda key: any_of(key, bits)))
    return written_table(some.select(F.explode("_keys").alias("key")).distinct(), "url-universe")


def url_verdicts(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", max_words: int = MAX_WORDS) -> DataFrame:
    """`page_id, host, path, rule, verdict` of each row; `rules` has `rule` and `verdict` (allow or block)."""
    host, path = host_and_path(F.col(url))
    judged = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rules = written_table(rules.groupBy("rule").agg(F.max("verdict").alias("verdict")), "url-rules")
    shapes = written_table(_rule_shapes(rules), "url-shapes")
    shaped = judged.withColumn("_shapes", shapes.scalar())
    keyed = shaped.select("page_id", "host", "path", candidates(F.col("host"), F.col("path"), F.col("_shapes")).alias("_keys"))
    of = lambda v: Cascade(rules.where(F.col("verdict") == v).select(F.col("rule").alias("key")), max_words)
    block, allow = of("block"), of("allow")
    if block.too_large or allow.too_large:
        return _by_join(keyed, rules)
    universe = _passing(keyed, [block, allow])
    for x in (block, allow):
        x.refine(universe)
    if block.too_large or allow.too_large:
        return _by_join(keyed, rules)

    def hit(key: Column, i: Column, bits: list[list[Column]]) -> Column:
        verdict = F.when(block.member(key, bits[0]), "block").when(allow.member(key, bits[1]), "allow")
        return F.struct((-F.length(key)).alias("size"), i.alias("i"), key.alias("rule"), verdict.alias("verdict"))

    # Label counts fall with i, so of equal lengths the longer host comes first.
    def first(keys: Column, bits: list[list[Column]]) -> Column:
        return F.array_min(F.filter(F.transform(keys, lambda key, i: hit(key, i, bits)), lambda x: x["verdict"].isNotNull()))

    found = _over_keys(keyed, [block, allow], None, first)
    verdict = F.coalesce("_keys.verdict", F.lit("allow"))
    return found.select("page_id", "host", "path", F.col("_keys.rule").alias("rule"), verdict.alias("verdict"))


def _by_join(keyed: DataFrame, rules: DataFrame) -> DataFrame:
    """The same for lists too large to send around: distinct key lists meet the rules in a shuffle."""
    lists = keyed.select("_keys").distinct()
    met = lists.select("_keys", F.posexplode("_keys").alias("i", "rule")).join(rules, "rule")
    best = met.groupBy("_keys").agg(F.min(F.struct((-F.length("rule")).alias("size"), "i", "rule", "verdict")).alias("_hit"))
    joined = keyed.join(best, "_keys", "left")
    verdict = F.coalesce("_hit.verdict", F.lit("allow"))
    return joined.select("page_id", "host", "path", F.col("_hit.rule").alias("rule"), verdict.alias("verdict"))
