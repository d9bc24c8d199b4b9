"""Quality rules judged by host: failures pooled per domain, shrunk by an empirical beta prior, joined back.

A text is measured once, inside one projection (no shuffle, no Python). What follows works on the narrow
measurements, which are written once: counts per host and rule, the prior of each rule from the spread
of the hosts' rates (method of moments), the posterior rate of each host, and the verdict on each document.

A rate is shrunk because small hosts say little: one failure among two documents is no reason to drop a
host, four hundred failures among five hundred are. `rate = (failed + a) / (documents + a + b)`.

Defined results: NULL and empty texts have no words, so they fail the base rules. Documents without a
host are judged by the base rules alone. Rows are judged one by one, so repeated rows repeat their result.
An empty table gives an empty result. Other columns pass through untouched, also under the names
used here for results when they are not asked for.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.let import bind
from millrace.llm.words import WHITE, small_side, words
from millrace.sources.scratch import written_table

#: Largest tolerated posterior failure rate of a host.
MAX_HOST_RATE = 0.5
#: Strength of the prior, in documents, when hosts do not differ beyond chance; and the strength at least.
STRONGEST, WEAKEST = 1e6, 1.0
SYMBOLS = "#*$%&|<>"
WINDOW = 3


def _with_equal_neighbour(entries: Column) -> Column:
    """Of an array of structs (key, i), those whose key occurs twice or more: equal ones are neighbours when sorted."""
    same = lambda a, b: F.coalesce(a["key"] == b["key"], F.lit(False))
    return bind(
        F.sort_array(entries),
        lambda s: F.filter(s, lambda x, k: same(F.get(s, k - 1), x) | same(F.get(s, k + 1), x)),
    )


def _covered(starts: Column) -> Column:
    """Words covered by the windows that begin at the sorted `starts`."""
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("upto"), F.lit(0).cast("bigint").alias("n")),
        lambda a, i: F.struct(
            (i + WINDOW).alias("upto"), (a["n"] + (i + WINDOW) - F.greatest(a["upto"], i)).alias("n")
        ),
        lambda a: a["n"],
    )


def _repeat_words(w: Column) -> Column:
    """Words covered by windows of three words that occur twice or more in the array `w`.

    Hashes only spare work: a text whose window hashes all differ has no repeated window, and elsewhere
    only windows with a repeated hash are compared, as text.
    """
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )

    def repeated(h: Column) -> Column:
        hashed = F.transform(h, lambda x, i: F.struct(x.alias("key"), i.alias("i")))
        as_text = F.transform(
            _with_equal_neighbour(hashed),
            lambda x: F.struct(
                F.concat_ws(" ", F.get(w, x["i"]), F.get(w, x["i"] + 1), F.get(w, x["i"] + 2)).alias("key"), x["i"].alias("i")
            ),
        )
        return _covered(F.sort_array(F.transform(_with_equal_neighbour(as_text), lambda x: x["i"])))

    none = F.lit(0).cast("bigint")
    found = bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(repeated(h)))
    return F.when(F.size(w) < WINDOW, none).otherwise(found)


def measures(text: Column) -> Column:
    """One struct of all measurements of a text; windows are compared as text, not by hash."""
    plain = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(plain, "\n", -1), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    line_counts = bind(
        lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))
    )
    counted = lambda w, lc: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        F.regexp_count(plain, F.lit(f"[{SYMBOLS}]")).cast("bigint").alias("n_symbols"),
        lc["dup"].cast("bigint").alias("n_dup_lines"),
        _repeat_words(w).alias("n_repeat_words"),
        lc["n"].cast("bigint").alias("n_lines"),
    )
    return bind(words(text), lambda w: bind(line_counts, lambda lc: counted(w, lc)))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Rules whose failures are pooled by host; each is false for a text without words, but for `short`."""
    n = F.col("n_words")
    return {
        "short": n < 50,
        "repeats": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") > 12 * n) | (F.col("word_chars") < 2 * n),
    }


def measured(docs: DataFrame, keep: list[str], text: str = "text", host: str = "source") -> DataFrame:
    """`keep` columns of `docs` plus `_host`, the measurements and one `_fails_<rule>` flag each, written once."""
    m = docs.select(*[F.col(c).alias(f"_kept_{c}") for c in keep], F.col(host).alias("_host"), F.col(text).alias("_text"))
    # The measuring expression is long and interpreted: one column of it, so that it runs once per row.
    m = m.select(*[c for c in m.columns if c != "_text"], F.explode(F.array(measures(F.col("_text")))).alias("_m"))
    m = m.select(*[c for c in m.columns if c != "_m"], "_m.*")
    m = m.withColumn("base_failed", base_failed()).withColumns({f"_fails_{k}": v for k, v in rules().items()})
    return written_table(m, "quality")


def host_verdicts(measured_docs: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: documents, posterior failure rate per rule, `_rejected`."""
    names = list(rules())
    hosts = (
        measured_docs.where(F.col("_host").isNotNull())
        .groupBy("_host")
        .agg(
            F.count(F.lit(1)).alias("host_docs"),
            *[F.count_if(F.col(f"_fails_{r}")).alias(f"_failed_{r}") for r in names],
        )
    )
    hosts = written_table(hosts, "quality-hosts")
    n = F.col("host_docs")
    means = hosts.agg(
        F.sum("host_docs").alias("n"), F.count(F.lit(1)).alias("h"), *[F.sum(f"_failed_{r}").alias(r) for r in names]
    ).first()
    total = means["n"] or 0
    mean = {r: (means[r] or 0) / total if total else 0.0 for r in names}
    spread = hosts.agg(*[F.sum(n * F.pow(F.col(f"_failed_{r}") / n - F.lit(mean[r]), F.lit(2))).alias(r) for r in names]).first()
    rates = {}
    for r in names:
        m = mean[r]
        chance = m * (1 - m)
        # Variance between hosts beyond what binomial draws of their sizes would show.
        beyond = ((spread[r] or 0.0) - chance * means["h"]) / total if total else 0.0
        strength = min(STRONGEST, max(WEAKEST, chance / beyond - 1)) if beyond > 0 else STRONGEST
        rates[f"rate_{r}"] = (F.col(f"_failed_{r}") + F.lit(m * strength)) / (n + F.lit(strength))
    rated = hosts.select("_host", "host_docs", *[v.alias(k) for k, v in rates.items()])
    return rated.withColumn("_rejected", reduce(or_, [F.col(k) > F.lit(max_rate) for k in rates]))


def judged(docs: DataFrame, keep: list[str], max_rate: float = MAX_HOST_RATE, **columns: str) -> DataFrame:
    """`keep` columns with measurements, `base_failed`, `host_rejected` and `kept`.

    Only rejected hosts are joined back. They are few where the corpus is sound; their number is checked
    before they are broadcast, and beyond the bound the join shuffles and splits hot hosts.
    """
    m = measured(docs, keep, **columns)
    bad = host_verdicts(m, max_rate).where("_rejected").select("_host", F.lit(True).alias("host_rejected"))
    joined = m.join(small_side(written_table(bad, "quality-rejected")), "_host", "left")
    joined = joined.withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
    kept = ~F.col("base_failed") & ~F.col("host_rejected")
    return joined.withColumn("kept", kept).drop("_host", *[f"_fails_{r}" for r in rules()])


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_verdicts(docs: DataFrame, doc_id: str = "doc_id", **columns: object) -> DataFrame:
    """One row per document: id, measurements, `base_failed`, `host_rejected`, `kept`."""
    return judged(docs, [doc_id], **columns).select(
        F.col(f"_kept_{doc_id}").alias(doc_id), *MEASURES, "base_failed", "host_rejected", "kept"
    )


def quality_filter(docs: DataFrame, **columns: object) -> DataFrame:
    """The documents that are kept, with their own columns."""
    good = judged(docs, docs.columns, **columns).where("kept")
    return good.select(*[F.col(f"_kept_{c}").alias(c) for c in docs.columns])
