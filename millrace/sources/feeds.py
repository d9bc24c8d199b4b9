"""Link discovery and the reading of article sources from already fetched pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.html import anchor_hrefs
from millrace.functions.urls import base_url, resolve_url
from millrace.sources.scratch import written_table


def discover_links(pages: DataFrame) -> DataFrame:
    """Links of each page (`url`, `html`) to its own host, first occurrence each, in document order.

    "Own host" is a test on the start of the text, so a longer host name that begins alike passes.
    """
    based = pages.withColumn("_base", base_url(F.col("url")))
    resolved = F.transform(anchor_hrefs(F.col("html")), lambda h: resolve_url(F.col("_base"), h))
    own = F.filter(resolved, lambda u: u.startswith(F.col("_base.origin")))
    kept = [c for c in pages.columns if c != "html"]
    # array_distinct keeps the first of equal elements: no shuffle is needed.
    return based.select(*kept, F.posexplode(F.array_distinct(own)).alias("pos", "link")).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


def sitemap_urls(sitemaps: DataFrame) -> DataFrame:
    """Non-empty `loc` values of each sitemap (`url`, `body`) in document order.

    A body that is not well-formed XML gives one row with `error` instead.
    """
    parsed = F.from_xml(
        F.col("body"),
        "url ARRAY<STRUCT<loc: STRING>>, _bad STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "ignoreSurroundingSpaces": "false"},
    )
    locs = F.filter(F.transform("_p.url", lambda u: u["loc"]), lambda x: x.isNotNull() & (x != ""))
    kept = [c for c in sitemaps.columns if c != "body"]
    each = sitemaps.withColumn("_p", parsed).select(
        *kept,
        F.posexplode(F.when(F.col("_p._bad").isNull(), locs).otherwise(F.array(F.lit("")))).alias("pos", "loc"),
    )
    return each.select(
        *kept,
        F.col("pos").cast("bigint").alias("pos"),
        F.nullif("loc", F.lit("")).alias("loc"),
        F.when(F.col("loc") == "", F.lit("sitemap is not well-formed")).alias("error"),
    )


def article_dispatch(
    catalog: DataFrame,
    pages: DataFrame,
    url_lists: DataFrame,
    sitemaps: DataFrame,
    markdown: DataFrame,
) -> DataFrame:
    """The pages of every article source, by the source's `type`.

    Inputs: catalog (`source_id`, `url`, `path`, `type`), pages (`url`, `html`), url_lists (`path`,
    `pos`, `url`), sitemaps (`url`, `body`), markdown (`repo_url`, `pos`, `content`); the url of a page
    or sitemap is unique. Output: `source_id`, `pos`, `url`, `content`, `error`. A missing page is
    skipped under an index or sitemap; it fails a single page or a whole URL list. A list or repository
    without any row counts as absent; every source gives at least an error row or what it has.
    """
    by_type = {
        t: catalog.where(F.col("type") == t)
        for t in ("single_page", "url_list", "blog_index", "markdown_repo", "sitemap")
    }

    def wanted(df: DataFrame, pos, url, required: bool, error=None) -> DataFrame:
        return df.select(
            "source_id",
            pos.cast("bigint").alias("pos"),
            url.alias("url"),
            F.lit(required).alias("required"),
            (F.lit(None) if error is None else error).cast("string").alias("error"),
        )

    absent_source = lambda what, c: F.concat(F.lit(f"no {what} at "), F.coalesce(c, F.lit("")))
    single = wanted(by_type["single_page"], F.lit(0), F.col("url"), True)
    by_list = by_type["url_list"].select("source_id", "path")
    listed = wanted(url_lists.join(by_list, "path"), F.col("pos"), F.col("url"), True)
    unlisted = by_list.join(url_lists.select("path").distinct(), "path", "left_anti")
    missing_list = wanted(unlisted, F.lit(0), F.col("path"), True, absent_source("address list", F.col("path")))
    indexed = by_type["blog_index"].select("source_id", "url").join(pages, "url", "left")
    missing_index = wanted(indexed.where("html IS NULL"), F.lit(0), F.col("url"), True, absent_source("page", F.col("url")))
    links = discover_links(indexed.where("html IS NOT NULL").select("source_id", "url", "html"))
    discovered = wanted(links, F.col("pos"), F.col("link"), False)
    maps = by_type["sitemap"].select("source_id", F.concat("url", F.lit("/sitemap.xml")).alias("url"))
    mapped = maps.join(sitemaps, "url", "left")
    missing_map = wanted(mapped.where("body IS NULL"), F.lit(0), F.col("url"), True, absent_source("page", F.col("url")))
    entries = sitemap_urls(mapped.where("body IS NOT NULL").select("source_id", "url", "body"))
    sitemap_pages = wanted(
        entries.select("source_id", "pos", F.col("loc").alias("url"), "error"),
        F.col("pos"), F.col("url"), False, F.col("error"),
    )
    repos = by_type["markdown_repo"].select("source_id", F.col("url").alias("repo_url"))
    unread = repos.join(markdown.select("repo_url").distinct(), "repo_url", "left_anti")
    missing_repo = wanted(unread, F.lit(0), F.col("repo_url"), True, absent_source("documents", F.col("repo_url")))
    requests = single.unionByName(listed).unionByName(discovered).unionByName(sitemap_pages)
    requests = requests.unionByName(missing_index).unionByName(missing_map)
    requests = requests.unionByName(missing_list).unionByName(missing_repo)
    # Addresses only, but from a deep plan: written once, read by each of the steps below.
    requests = written_table(requests, "page-requests")

    addresses = pages.select("url", F.lit(True).alias("found"))
    absent = (
        requests.where("required AND error IS NULL").join(addresses, "url", "left")
        .where("found IS NULL")
        .withColumn("error", absent_source("page", F.col("url")))
    )
    columns = ("source_id", "pos", "url", "error")
    failures = (
        requests.where("error IS NOT NULL").select(*columns).unionByName(absent.select(*columns))
        .groupBy("source_id")
        .agg(F.min_by(F.struct("pos", "url", "error"), "pos").alias("f"))
        .select("source_id", "f.*")
    )
    failures = written_table(failures, "failed-sources")
    # Failing sources go first, so that page texts are joined once and only where they are kept.
    good = requests.where("error IS NULL").select("source_id", "pos", "url")
    good = good.join(failures.select("source_id"), "source_id", "left_anti")
    contents = good.join(pages.select("url", F.col("html").alias("content")), "url")
    documents = markdown.join(repos, "repo_url")
    unknown = catalog.where(~F.coalesce("type", F.lit("")).isin(*by_type))
    none = F.lit(None).cast("string")
    return (
        contents.select("source_id", "pos", "url", "content", none.alias("error"))
        .unionByName(documents.select("source_id", "pos", F.col("repo_url").alias("url"), "content", none.alias("error")))
        .unionByName(failures.select("source_id", "pos", "url", none.alias("content"), "error"))
        .unionByName(
            unknown.select(
                "source_id",
                F.lit(0).cast("bigint").alias("pos"),
                "url",
                none.alias("content"),
                F.concat(F.lit("no such kind of source: "), F.coalesce("type", F.lit(""))).alias("error"),
            )
        )
    )
