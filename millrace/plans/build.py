"""The dataset build: code files to shuffled, split examples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.draws import digest
from millrace.operators.extract import code_units, drop_generated_files, prose_sections
from millrace.operators.filters import filter_all
from millrace.operators.formats import EXAMPLE_COLUMNS, EXPLAIN, PAIR_CATEGORIES, format_by_mode, prose_pairs
from millrace.operators.sampling import grouped_split, is_fim, oversample, train_eval_split, with_draws
from millrace.sources.catalog import read_sources, source_catalog
from millrace.sources.feeds import article_dispatch
from millrace.sources.files import scan_code_files, scan_repositories
from millrace.sources.jsonl import folder_exists, write_splits
from millrace.sources.scratch import written_table

UNIT_KEY = ("file_path", "line_number")
#: Paths repeat where several trees are landed in one table; bodies do not after the dedup.
EXAMPLE_KEY = ("source", "line_number", "body_key")


@dataclass(frozen=True)
class BuildOptions:
    min_lines: int = 3
    fim_ratio: float = 0.4
    seed: int = 42
    eval_split: float = 0.1


def examples_from_units(units: DataFrame, options: BuildOptions = BuildOptions(), *others: str) -> DataFrame:
    """Filtered, deduplicated and formatted units with their key, shuffle draw and other columns; one shuffle."""
    kept = filter_all(units, options.min_lines)
    drawn = with_draws(kept, options.seed, UNIT_KEY).withColumn("body_key", F.sha2("body", 256))
    formatted = format_by_mode(drawn, is_fim(options.fim_ratio), F.col("cut_draw"))
    return formatted.select(*EXAMPLE_COLUMNS, "line_number", "body_key", "shuffle_draw", *others)


def build_dataset(files: DataFrame, options: BuildOptions = BuildOptions()) -> DataFrame:
    """Examples of all code files (`path`, `src`) with their `split`.

    The examples are written once: the split needs them three times, twice as keys only, and extraction
    and dedup must not run again for that, nor after the loss of an executor.
    """
    units = code_units(drop_generated_files(files))
    examples = written_table(examples_from_units(units, options), "examples")
    # A split of 0 means the default, as in the option's definition.
    return train_eval_split(examples, EXAMPLE_KEY, options.eval_split or 0.1)


def code_examples(files: DataFrame, options: BuildOptions = BuildOptions()) -> DataFrame:
    """Examples of code files (`origin`, `path`, `src`) with `origin`, `example_id` and `group_id`; equal bodies of all origins count once."""
    units = code_units(drop_generated_files(files))
    examples = examples_from_units(units, options, "origin")
    key = digest(options.seed, (F.lit("code"), "body_key"))
    return examples.select(*EXAMPLE_COLUMNS, "origin", key.alias("example_id"), key.alias("group_id"))


def article_examples(articles: DataFrame, options: BuildOptions = BuildOptions()) -> DataFrame:
    """Both directions of each code block of read articles (`source_id`, `pos`, `url`, `content`); the origin is the address.

    A group is a prose and a code text: its two directions, and its copies on other pages.
    """
    pages = articles.where("content IS NOT NULL").select(F.struct("source_id", "pos", "url").alias("page_id"), F.col("content").alias("html"))
    pairs = prose_pairs(prose_sections(pages))
    forward = F.col("category") == PAIR_CATEGORIES[0]
    prose = F.when(forward, F.col("instruction")).otherwise(F.col("output"))
    code = F.when(forward, F.col("output")).otherwise(F.substr("instruction", F.lit(len(EXPLAIN) + 1)))
    place = ("page_id.source_id", "page_id.pos", "page_id.url", "section_no", "block_no")
    return pairs.select(
        *EXAMPLE_COLUMNS,
        F.col("page_id.url").alias("origin"),
        digest(options.seed, ("category", *place)).alias("example_id"),
        digest(options.seed, (F.sha2(prose, 256), F.sha2(code, 256))).alias("group_id"),
    )


def merge_sources(
    code: DataFrame, articles: DataFrame, weights: DataFrame, options: BuildOptions = BuildOptions()
) -> DataFrame:
    """Code and article examples of all origins in one dataset, split by category and weighted by origin.

    Both inputs have the example columns, `origin`, an `example_id` that is unique over both, and a `group_id` whose examples
    must not be parted; `weights` has `origin` and `effective_weight`. The two directions of a block are one
    category here. Examples are split before they are repeated, and only the 'train' ones are repeated, so no copy of an
    evaluation example is trained on, nor its counterpart.
    """
    columns = [*EXAMPLE_COLUMNS, "origin", "example_id", "group_id"]
    merged = with_draws(code.select(columns).unionByName(articles.select(columns)), options.seed, ("example_id",))
    kind = F.when(F.col("category").isin(*PAIR_CATEGORIES), "pair").otherwise(F.col("category"))
    merged = written_table(merged.drop("mode_draw", "cut_draw").withColumn("_kind", kind), "merged")
    labelled = grouped_split(merged, "group_id", "_kind", options.seed, options.eval_split or 0.1)
    return oversample(labelled.drop("_kind"), weights, "origin", F.col("split") == "train")


def build_counters(examples: DataFrame, fim: Column | None = None) -> DataFrame:
    """One row: total, train, eval, fim and instruction examples.

    An example with a `text` counts as fim; `fim` can say the same from a cheaper column.
    """
    fim = F.coalesce("text", F.lit("")) != "" if fim is None else fim
    return examples.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "eval").alias("eval"),
        F.count_if(fim).alias("fim"),
        F.count_if(~fim).alias("instr"),
    )


def build_from_dir(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    options: BuildOptions = BuildOptions(),
    mode: str = "errorifexists",
) -> DataFrame:
    """Scan a code tree, build, write `split=train` and `split=eval` JSON Lines; gives the counters.

    Unless `mode` is "overwrite", an output folder that exists is refused before any work is done.
    """
    if mode != "overwrite" and folder_exists(spark, output_dir):
        raise FileExistsError(output_dir)
    examples = build_dataset(scan_code_files(spark, input_dir), options)
    write_splits(examples, output_dir, ("shuffle_draw", *EXAMPLE_KEY), mode)
    # Exactly the fim examples have a text, and the category is far smaller to read.
    return build_counters(examples, F.col("category") == "fim")


def build_from_sources(
    spark: SparkSession,
    catalog_path: str,
    output_dir: str,
    pages: DataFrame,
    url_lists: DataFrame,
    sitemaps: DataFrame,
    markdown: DataFrame,
    options: BuildOptions = BuildOptions(),
    mode: str = "errorifexists",
) -> DataFrame:
    """The dataset of a whole catalog: landed repositories and already fetched articles; gives the counters.

    Repositories are scanned, articles read as `article_dispatch` does from the tables it names. Sources that fail give
    no examples. Weights of repositories repeat their training examples; articles have none.
    """
    if mode != "overwrite" and folder_exists(spark, output_dir):
        raise FileExistsError(output_dir)
    repos, articles = read_sources(spark, catalog_path)
    catalog = source_catalog(repos)
    origin = F.coalesce(F.nullif("url", F.lit("")), "dir")
    weights = catalog.select(origin.alias("origin"), "effective_weight")
    listed = articles.distinct().withColumn("source_id", digest(options.seed, ("type", "url", "path")))
    read = article_dispatch(listed, pages, url_lists, sitemaps, markdown)
    merged = merge_sources(
        code_examples(scan_repositories(spark, catalog), options), article_examples(read, options), weights, options
    )
    # Copies are spread like other examples.
    order = with_draws(merged.drop("shuffle_draw"), options.seed, ("example_id", "copy_no"))
    merged = written_table(order.drop("mode_draw", "cut_draw"), "dataset")
    write_splits(merged, output_dir, ("shuffle_draw", "example_id", "copy_no"), mode)
    return build_counters(merged, F.col("category") == "fim")
