"""JSON parsing that accepts one complete value only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_whole(text: Column, fields: str) -> Column:
    """Parse `text` as one JSON object with `fields` (DDL); struct of `value` and `ok`.

    `from_json` ignores what follows the first value. Wrapping the text as an object member and, again,
    as the only element of an array makes any trailing text a syntax error.
    """
    wrapped = F.from_json(
        F.concat(F.lit('{"value":'), text, F.lit("}")),
        f"value STRUCT<{fields}>, _bad STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"},
    )
    alone = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")
    ok = wrapped["_bad"].isNull() & (F.size(alone) == 1)
    return F.struct(wrapped["value"].alias("value"), F.coalesce(ok, F.lit(False)).alias("ok"))
