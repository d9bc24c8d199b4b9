"""File scans: code trees, Markdown trees and URL lists."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import trim_space

SKIPPED_DIRECTORY = "vendor"
#: Folders of one scan; each is listed by the driver.
MAX_ROOTS = 10_000


def path_order(path: Column) -> Column:
    """Sort key that visits a tree directory by directory, names in order."""
    return F.split(path, "/", -1)


def wanted_code_path(path: Column, extension: str = ".go") -> Column:
    """Exact extension, and no `vendor` directory at any depth."""
    parts = F.split(path, "/", -1)
    directories = F.slice(parts, 1, F.size(parts) - 1)
    return path.endswith(extension) & ~F.array_contains(directories, SKIPPED_DIRECTORY)


def select_code_files(files: DataFrame, extension: str = ".go") -> DataFrame:
    """The code-tree rules for a table of landed files with a relative `path` column."""
    return files.where(wanted_code_path(F.col("path"), extension))


def _whole_files(spark: SparkSession, roots: dict[str, str], extension: str) -> DataFrame:
    """`root, path, src` of all files below some folders (plain path -> full address); `path` is relative to the innermost."""
    reader = (
        spark.read.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{extension}")
    )
    # File URIs are percent-encoded; '+' is literal in them. Scheme and host are not part of the path.
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    plain = F.regexp_replace(plain, "^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", "")
    known = F.create_map(*(F.lit(x) for r in roots for x in (r.rstrip("/"), r.rstrip("/"))))
    # A root is found by the leading part of the path, one look-up for each number of parts, the longest first.
    depths = sorted({r.rstrip("/").count("/") + 1 for r in roots}, reverse=True)
    found = [F.try_element_at(known, F.substring_index("_plain", "/", d)) for d in depths]
    files = reader.load(list(roots.values())).select(plain.alias("_plain"), F.col("value").alias("src"))
    outside = F.raise_error(F.concat(F.lit("file outside the scanned folder: "), F.col("_plain")))
    rooted = files.select("_plain", F.coalesce(*found, outside).alias("root"), "src")
    return rooted.select("root", F.substr("_plain", F.length("root") + 2).alias("path"), "src")


def _qualified_roots(spark: SparkSession, root: str) -> dict[str, str]:
    """Folders that `root` names (relative, with `.`, `..`, doubled slashes, or a glob): plain path -> full address."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(system.makeQualified(path)) or []
    roots = {}
    for status in found:
        uri = status.getPath().toUri().normalize()
        address = status.getPath().toString()[: -len(status.getPath().toUri().getPath())] + uri.getPath()
        roots[uri.getPath()] = address
    if not roots:
        raise FileNotFoundError(root)
    return roots


def scan_code_files(spark: SparkSession, root: str, extension: str = ".go") -> DataFrame:
    """One row (`path`, `src`) per code file under `root`, `vendor` directories left out."""
    return select_code_files(_whole_files(spark, _qualified_roots(spark, root), extension).drop("root"), extension)


def scan_markdown(spark: SparkSession, root: str, extension: str = ".md") -> DataFrame:
    """One row (`path`, `content`) per non-empty Markdown file under `root`."""
    files = _whole_files(spark, _qualified_roots(spark, root), extension).drop("root")
    return files.where(F.octet_length("src") > 0).withColumnRenamed("src", "content")


def scan_repositories(spark: SparkSession, repos: DataFrame, extension: str = ".go") -> DataFrame:
    """`origin, path, src` of the code files of all local repositories of a catalog, in one scan.

    `repos` is a `source_catalog` of at most `MAX_ROOTS` rows. A repository's code lies in `path` below its `dir`; its origin is its
    `url`, or else its `dir`. Repositories that are not landed, or whose folder is missing, are left out with a warning.
    The rules of a tree hold below each folder; the `path` given is the whole one, so that it tells repositories apart.
    """
    listed = repos.select("url", "dir", "path", "is_local").limit(MAX_ROOTS + 1).collect()
    if len(listed) > MAX_ROOTS:
        raise ValueError(f"at most {MAX_ROOTS} repositories at once")
    roots, origins = {}, {}
    for r in sorted(listed, key=lambda r: (r.dir or "", r.path or "", r.url or "")):
        try:
            found = _qualified_roots(spark, f"{r.dir.rstrip('/')}/{r.path or ''}") if r.is_local else {}
        except FileNotFoundError:
            found = {}
        if not found:
            warnings.warn(f"no folder of repository {r.url or r.dir}", stacklevel=2)
        for plain, address in found.items():
            roots[plain] = address
            origins.setdefault(plain.rstrip("/"), r.url or r.dir)
    if not roots:
        return spark.createDataFrame([], "origin string, path string, src string")
    files = select_code_files(_whole_files(spark, roots, extension), extension)
    origin = F.create_map(*(F.lit(x) for pair in origins.items() for x in pair))
    return files.select(F.try_element_at(origin, F.col("root")).alias("origin"), F.concat_ws("/", "root", "path").alias("path"), "src")


def list_entries(lines: DataFrame, column: str = "value") -> DataFrame:
    """Trim lines; drop blank ones and those that start with '#'."""
    url = trim_space(F.col(column))
    return lines.withColumn(column, url).where((F.col(column) != "") & ~F.col(column).startswith("#"))


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """The URLs of a text file (or folder of text files), one row each."""
    return list_entries(spark.read.text(path)).select(F.col("value").alias("url"))
