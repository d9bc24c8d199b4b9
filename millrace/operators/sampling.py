"""Seeded mode choice, shuffle, exact split, and the small validation sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.draws import DRAW_RANGE, digest, draw
from millrace.sources.scratch import small_side, written_table

_BUCKET_BITS = 16


def with_draws(df: DataFrame, seed: int, keys: Sequence[str]) -> DataFrame:
    """Add `mode_draw`, `cut_draw` and `shuffle_draw`, all read from one digest of the key."""
    hashed = df.withColumn("_digest", digest(seed, keys))
    return hashed.withColumns(
        {f"{p}_draw": draw(F.col("_digest"), p) for p in ("mode", "cut", "shuffle")}
    ).drop("_digest")


def is_fim(fim_ratio: float) -> Column:
    """True for a share `fim_ratio` of the rows."""
    return F.col("mode_draw") < F.lit(float(fim_ratio) * DRAW_RANGE)


def seeded_shuffle(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Global order by `shuffle_draw`; the draws are uniform, so the range partitions are even."""
    return df.orderBy("shuffle_draw", *keys)


def eval_size(n: Column, split: float) -> Column:
    """trunc(n * split), at least 1, at most n - 1, never negative."""
    wanted = (n * F.lit(float(split))).cast("bigint")
    return F.greatest(F.lit(0), F.least(n - 1, F.greatest(F.lit(1), wanted)))


def train_eval_split(df: DataFrame, keys: Sequence[str], split: float = 0.1) -> DataFrame:
    """Add `split`: exactly the first `eval_size` rows in shuffled order are 'eval'.

    Nothing is ranked globally. Row counts by the upper half of the draw's bits (at most 65,536 rows) tell in which
    bucket the last eval row lies, counts by the lower half in that bucket tell its draw, and only keys with
    exactly that draw are ranked: one in 2^32 of all. The row found becomes the threshold every row is compared with. All
    steps read the draw and key columns only. The keys have to be unique: rows that tie with the threshold all go to the same side.
    """
    position = F.struct("shuffle_draw", *keys)
    counts = df.groupBy(_bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = counts.withColumn("nth", eval_size(F.sum("rows").over(everything), split))
    # One struct, so that both uses are the same subquery and run once.
    bucket = _holder(wanted, "bucket").select(F.struct("bucket", "nth").alias("b")).scalar()
    draws = df.where(_bucket() == bucket["bucket"]).groupBy("shuffle_draw").agg(F.count(F.lit(1)).alias("rows"))
    drawn = _holder(draws.withColumn("nth", bucket["nth"]), "shuffle_draw").select(F.struct("shuffle_draw", "nth").alias("d")).scalar()
    tied = df.select("shuffle_draw", *keys).where(F.col("shuffle_draw") == drawn["shuffle_draw"])
    ranked = tied.withColumn("_rank", F.row_number().over(Window.orderBy(*keys)))
    last = ranked.where(F.col("_rank") == drawn["nth"]).select(position.alias("p"))
    in_eval = F.coalesce(position <= last.scalar(), F.lit(False))
    return df.withColumn("split", F.when(in_eval, "eval").otherwise("train"))


def _bucket() -> Column:
    return F.shiftright("shuffle_draw", 32 - _BUCKET_BITS)


def _holder(counts: DataFrame, by: str, within: str | None = None) -> DataFrame:
    """Of counted groups (`rows`) in the order of `by` the one that holds row number `nth`, which is counted inside it then."""
    ordered = Window.partitionBy(within).orderBy(by) if within else Window.orderBy(by)
    before = counts.withColumn("_before", F.sum("rows").over(ordered) - F.col("rows"))
    held = before.where((F.col("_before") < F.col("nth")) & (F.col("nth") <= F.col("_before") + F.col("rows")))
    return held.withColumn("nth", F.col("nth") - F.col("_before")).drop("_before", "rows")


def _last_positions(df: DataFrame, keys: Sequence[str], stratum: str, split: float) -> DataFrame:
    """`_stratum, _last`: draw and keys of the last eval row of each stratum that has one."""
    met = F.col(stratum).eqNullSafe(F.col("_stratum"))
    named = F.col(stratum).alias("_stratum")
    counts = df.groupBy(named, _bucket().alias("_bucket")).agg(F.count(F.lit(1)).alias("rows"))
    wanted = counts.withColumn("nth", eval_size(F.sum("rows").over(Window.partitionBy("_stratum")), split))
    buckets = _holder(wanted, "_bucket", "_stratum")
    near = df.select(stratum, "shuffle_draw").join(buckets, met & (_bucket() == F.col("_bucket")))
    draws = near.groupBy("_stratum", "nth", F.col("shuffle_draw").alias("_draw")).agg(F.count(F.lit(1)).alias("rows"))
    drawn = _holder(draws, "_draw", "_stratum")
    tied = df.select(stratum, "shuffle_draw", *keys).join(drawn, met & (F.col("shuffle_draw") == F.col("_draw")))
    rank = F.row_number().over(Window.partitionBy("_stratum").orderBy(*keys))
    last = tied.select("_stratum", "nth", F.struct("shuffle_draw", *keys).alias("_last"), rank.alias("_rank"))
    return last.where("_rank = nth").select("_stratum", "_last")


def _labelled(df: DataFrame, position: Column, last: DataFrame, stratum: str) -> DataFrame:
    joined = df.join(small_side(last, "strata"), F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    in_eval = F.coalesce(position <= F.col("_last"), F.lit(False))
    return joined.withColumn("split", F.when(in_eval, "eval").otherwise("train")).drop("_stratum", "_last")


def stratified_split(df: DataFrame, keys: Sequence[str], stratum: str, split: float = 0.1) -> DataFrame:
    """Add `split`: in each stratum exactly the first `eval_size` rows in shuffled order are 'eval'.

    As in `train_eval_split`, for all strata in one pass. NULL is a stratum of its own, a stratum of one row is 'train'.
    The keys have to be unique.
    """
    return _labelled(df, F.struct("shuffle_draw", *keys), _last_positions(df, keys, stratum, split), stratum)


def grouped_split(df: DataFrame, group: str, stratum: str, seed: int, split: float = 0.1) -> DataFrame:
    """Add `split`: in each stratum exactly the first `eval_size` groups in shuffled order are 'eval', with all their rows.

    The draw is the group's, so rows find their side without meeting the others of the group. A group lies in one stratum.
    """
    drawn = df.withColumn("_group_draw", draw(digest(seed, (group,)), "shuffle"))
    groups = drawn.select(stratum, group, F.col("_group_draw").alias("shuffle_draw")).distinct()
    last = _last_positions(written_table(groups, "groups"), (group,), stratum, split)
    return _labelled(drawn, F.struct(F.col("_group_draw").alias("shuffle_draw"), group), last, stratum).drop("_group_draw")


def oversample(df: DataFrame, weights: DataFrame, by: str, where: Column | None = None) -> DataFrame:
    """Repeat each row `ceil(effective_weight)` times, at least once, and number the copies in `copy_no`.

    `weights` has `by` and `effective_weight`; rows without a weight, and those that are not `where`, stay single.
    Of repeated weights the largest counts.
    """
    heaviest = weights.groupBy(F.col(by).alias("_by")).agg(F.max("effective_weight").alias("_weight"))
    copies = F.greatest(F.lit(1), F.ceil(F.coalesce("_weight", F.lit(1.0)))).cast("int")
    if where is not None:
        copies = F.when(where, copies).otherwise(1)
    joined = df.join(small_side(heaviest, "weights"), F.col(by) == F.col("_by"), "left")
    return joined.withColumn("copy_no", F.explode(F.sequence(F.lit(1), copies))).drop("_by", "_weight")


def validation_sample(df: DataFrame, order: Sequence[str | Column], n: int = 10, train: int = 8) -> DataFrame:
    """The first `n` rows: `train` of them labelled 'train', the others 'eval'."""
    first = df.orderBy(*order).limit(n)
    rank = F.row_number().over(Window.orderBy(*order))
    return first.withColumn("split", F.when(rank <= train, "train").otherwise("eval"))
