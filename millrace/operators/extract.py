"""Extraction: code files to function units, pages to prose/code sections. No shuffle anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import gosource
from millrace.functions.html import mark_blocks
from millrace.functions.let import bind
from millrace.functions.text import first_line, head_contains, trim_space, unguard

# What marks a file as machine-written, and how far into it that is looked for.
FILE_MARKERS = ("DO NOT EDIT", "Code generated")
MARKER_WINDOW = 512


def drop_generated_files(files: DataFrame) -> DataFrame:
    """Keep files (`src`) whose first bytes carry no generated-code marker."""
    return files.where(~head_contains(F.col("src"), FILE_MARKERS, MARKER_WINDOW))


def unit_signature(from_body: bool = False) -> Column:
    """The `func` line without its brace, or else the first body line: the doc line where there is one."""
    line = first_line(F.col("unit.body")) if from_body else gosource.code_part(F.col("unit.declaration"))
    return F.regexp_replace(line, r" \{$", "")


def code_units(files: DataFrame, signature_from_body: bool = False) -> DataFrame:
    """One row per top-level function or method of each file (`path`, `src`).

    `body` is the source text including the doc comment, `imports` every import of the file, and
    `line_number` the line of the `func` keyword. Comments in bodies stay. A file whose first code is not a package clause, whose
    brackets don't match or that leaves a literal or comment open gives no unit; other errors are not looked for.
    Other columns of the files are repeated with their units.
    """
    others = [c for c in files.columns if c not in ("path", "src")]
    folded = files.select("path", *others, gosource.fold(F.col("src")).alias("file"))

    # What the file says of all its units is made in the exploded array as well: beside it, it would be made
    # again from the whole text for every unit.
    def of_file(text: Column, package: Column, imports: Column) -> Column:
        fields = ("line_number", "doc", "declaration", "body")
        return F.transform(
            gosource.declarations(text),
            lambda u: F.struct(*[u[f].alias(f) for f in fields], package.alias("package"), imports.alias("imports")),
        )

    text = F.col("file.folded")
    units = folded.select(
        "path",
        *others,
        F.explode(
            F.when(
                F.col("file.sound"),
                bind(
                    gosource.package_name(text),
                    lambda package: bind(gosource.import_paths(text), lambda imports: of_file(text, package, imports)),
                ),
            )
        ).alias("unit"),
    )
    declaration = F.col("unit.declaration")
    return units.select(
        "unit.package",
        F.regexp_extract(declaration, r"^func (?:\([^)]*\) ?)?([^\s(\[]+)", 1).alias("name"),
        F.regexp_extract(declaration, r"^func \((?:[^\s()*\[\]]+\s+)?([^()]+?)\s*\)", 1).alias("receiver"),
        "unit.doc",
        unit_signature(signature_from_body).alias("signature"),
        "unit.body",
        "unit.imports",
        F.col("path").alias("file_path"),
        "unit.line_number",
        *others,
    )


def prose_sections(pages: DataFrame) -> DataFrame:
    """One row per section of a page (`page_id`, `html`): a heading h1-h3 with the prose and code below.

    Sections with neither prose nor code vanish; text before the first heading has an empty title.
    """
    marked = pages.select("page_id", mark_blocks(F.col("html")).alias("marked"))

    def section(text, i):
        pieces = F.split(text, "\x01", -1)
        # The first piece is the title; it may itself begin with a marker letter.
        tokens = F.slice(pieces, 2, F.size(pieces))

        def of_kind(letter):
            chosen = F.filter(tokens, lambda t: t.startswith(letter))
            texts = F.transform(chosen, lambda t: trim_space(F.substr(t, F.lit(2))))
            return F.transform(F.filter(texts, lambda t: t != ""), unguard)

        return F.struct(
            unguard(F.when(i > 0, F.get(pieces, F.lit(0))).otherwise(F.lit(""))).alias("title"),
            F.array_join(of_kind("P"), "\n").alias("prose"),
            of_kind("C").alias("code_blocks"),
        )

    sections = F.filter(
        F.transform(F.split("marked", "\x01H", -1), section),
        lambda s: (s["prose"] != "") | (F.size(s["code_blocks"]) > 0),
    )
    return marked.select("page_id", F.posexplode(sections).alias("section_no", "section")).select(
        "page_id", F.col("section_no").cast("bigint").alias("section_no"), "section.*"
    )
