"""Seeded pseudo-random draws that depend on a row's key only.

One SHA-256 per row gives every draw a row needs: each purpose reads its own 32 bits of the digest, so
the draws are independent of each other and of how the rows are partitioned or retried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First hex digit (1-based) of each purpose's slice of the digest.
PURPOSES = {"mode": 1, "cut": 9, "shuffle": 17}

DRAW_RANGE = 2**32


def digest(seed: int, keys: Sequence[str | Column]) -> Column:
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[_part(c.cast("string")) for c in cols]), 256)


def _part(key: Column) -> Column:
    """A key part in which `|` and NULL cannot be taken for anything else."""
    escaped = F.regexp_replace(key, r"[\\|]", r"\\$0")
    return F.coalesce(escaped, F.lit("\\N"))


def draw(hex_digest: Column, purpose: str) -> Column:
    """A uniform integer in [0, 2**32)."""
    return F.conv(F.substring(hex_digest, PURPOSES[purpose], 8), 16, 10).cast("bigint")
