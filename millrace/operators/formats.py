"""Formatting: units and sections to example rows. Projections only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fill-in-the-middle markers and prompt texts.
FIM_PREFIX = "<|fim_prefix|>"
FIM_SUFFIX = "<|fim_suffix|>"
FIM_MIDDLE = "<|fim_middle|>"
IMPLEMENT = "Implement the Go function: "
EXPLAIN = "Explain this Go code:\n\n"
SYSTEM_PROMPT = "You are an expert Go developer. Respond with Go code only, no explanations."
JUDGE_PROMPT = (
    "Rate this Go code on a scale of 1-5 for each criterion.\n"
    'Respond with JSON only: {"correctness": N, "idiom": N, "simplicity": N, "completeness": N}\n\n'
    "Original prompt: %s\n\n"
    "Code to evaluate:\n%s"
)
MIN_FIM_BYTES = 10
#: The two directions of a code block.
PAIR_CATEGORIES = ("prose_to_code", "code_to_prose")
_CUT_COLUMNS = ("_size", "_cut", "_resume")

EXAMPLE_COLUMNS = ("text", "instruction", "output", "source", "category")
EXAMPLE_SCHEMA = ", ".join(f"{c} STRING" for c in EXAMPLE_COLUMNS)


def long_enough_for_fim(body: Column) -> Column:
    return F.octet_length(body) >= MIN_FIM_BYTES


def with_cuts(units: DataFrame, cut_draw: Column) -> DataFrame:
    """Add `_cut` and `_resume`, the character positions at which a body is cut.

    The first cut falls in the middle half, the second halfway between it and the end. Positions count
    characters, so no character is cut apart.
    """
    size = F.col("_size")
    low, high = F.floor(size / 4), F.floor(size * 3 / 4)
    sized = units.withColumn("_size", F.char_length("body"))
    # Bodies too short to be cut have no room between the bounds.
    cut = sized.withColumn("_cut", (low + cut_draw % F.greatest(high - low, F.lit(1))).cast("int"))
    return cut.withColumn("_resume", (F.col("_cut") + F.floor((size - F.col("_cut")) / 2)).cast("int"))


def fim_text() -> Column:
    """Prefix, suffix and middle of a cut body, in this order."""
    body, cut, resume = F.col("body"), F.col("_cut"), F.col("_resume")
    return F.concat(
        F.lit(FIM_PREFIX),
        F.substr(body, F.lit(1), cut),
        F.lit(FIM_SUFFIX),
        F.substr(body, resume + 1),
        F.lit(FIM_MIDDLE),
        F.substr(body, cut + 1, resume - cut),
    )


def instruction_text() -> Column:
    return F.when(
        F.col("doc") == "", F.concat(F.lit(IMPLEMENT), F.col("signature"))
    ).otherwise(F.concat(F.col("doc"), F.lit("\n\nSignature: "), F.col("signature")))


def format_fim(units: DataFrame, cut_draw: Column) -> DataFrame:
    """Units (`body`, `file_path`) to fill-in-the-middle examples; too short ones are dropped."""
    return with_cuts(units.where(long_enough_for_fim(F.col("body"))), cut_draw).withColumns(
        {
            "text": fim_text(),
            "instruction": F.lit(""),
            "output": F.lit(""),
            "source": F.col("file_path"),
            "category": F.lit("fim"),
        }
    ).drop(*_CUT_COLUMNS)


def format_instruction(units: DataFrame) -> DataFrame:
    """Units (`doc`, `signature`, `body`, `file_path`) to instruction examples."""
    return units.withColumns(
        {
            "text": F.lit(""),
            "instruction": instruction_text(),
            "output": F.col("body"),
            "source": F.col("file_path"),
            "category": F.lit("instruction"),
        }
    )


def format_by_mode(units: DataFrame, is_fim: Column, cut_draw: Column) -> DataFrame:
    """Both formats in one projection, chosen per row; FIM units that are too short are dropped."""
    body = F.col("body")
    return with_cuts(units.where(~is_fim | long_enough_for_fim(body)), cut_draw).withColumns(
        {
            "text": F.when(is_fim, fim_text()).otherwise(""),
            "instruction": F.when(is_fim, "").otherwise(instruction_text()),
            "output": F.when(is_fim, "").otherwise(body),
            "source": F.col("file_path"),
            "category": F.when(is_fim, "fim").otherwise("instruction"),
        }
    ).drop(*_CUT_COLUMNS)


def prose_pairs(sections: DataFrame) -> DataFrame:
    """Two examples per code block of a section: prose to code, then code to prose."""
    blocks = sections.select("*", F.posexplode("code_blocks").alias("block_no", "code"))
    pair = F.array(
        F.struct(
            F.col("prose").alias("instruction"), F.col("code").alias("output"), F.lit(PAIR_CATEGORIES[0]).alias("category")
        ),
        F.struct(
            F.concat(F.lit(EXPLAIN), F.col("code")).alias("instruction"),
            F.col("prose").alias("output"),
            F.lit(PAIR_CATEGORIES[1]).alias("category"),
        ),
    )
    kept = [c for c in sections.columns if c not in ("title", "prose", "code_blocks")]
    return blocks.select(*kept, "block_no", F.explode(pair).alias("p")).select(
        *kept,
        F.col("block_no").cast("bigint").alias("block_no"),
        F.lit("").alias("text"),
        "p.instruction",
        "p.output",
        F.lit("").alias("source"),
        "p.category",
    )


def render_training_text(examples: DataFrame) -> DataFrame:
    """The single string an example is trained on."""
    empty = F.lit("")
    rendered = F.concat(
        F.lit("### Instruction:\n"),
        F.coalesce("instruction", empty),
        F.lit("\n\n### Response:\n"),
        F.coalesce("output", empty),
    )
    text = F.coalesce("text", empty)
    return examples.withColumn("rendered", F.when(text != "", text).otherwise(rendered))


def judge_prompt(pairs: DataFrame) -> DataFrame:
    """Rating request for a `prompt` and the `response` to it."""
    before, between, after = JUDGE_PROMPT.split("%s")
    text = F.concat(F.lit(before), F.col("prompt"), F.lit(between), F.col("response"), F.lit(after))
    return pairs.withColumn("judge_prompt", text)


def chat_request(prompts: DataFrame, model: str | Column) -> DataFrame:
    """JSON request body for each `prompt`."""
    model = F.lit(model) if isinstance(model, str) else model

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    messages = F.array(message("system", F.lit(SYSTEM_PROMPT)), message("user", F.col("prompt")))
    return prompts.withColumn(
        "request", F.to_json(F.struct(model.alias("model"), messages.alias("messages")))
    )
