"""Seeded exact-size sample and train/eval split.

Rows are ordered by a hash of the seed and the row's order columns, and rows of
equal order columns by a hash of all other columns, which no partitioning can change.
Both operators only look for the hash value at the wanted position and then
filter, so no rows are sorted or moved. They read their input more than once:
pass a written table, see ``codeprep.staging``. Sizes are exact, also where rows
repeat: if only some of the rows that share the last hash value are wanted, these
alone are written and counted off.

``split_by_share`` needs neither a count nor a second look at a row, and holds on a
stream; its sizes are as near to the share as hashes fall.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from codeprep.operators.ranking import number_as_stored, smallest_cutoff
from codeprep.sources.instructions import ORDER

# Default seed and eval share.
SEED = 42
EVAL_SHARE = 0.02


def shuffle_key(seed: int = SEED, ids: Sequence[str] = ORDER) -> Column:
    """Hash that orders the rows; ``ids`` identify a row."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *ids))


def full_key(df: DataFrame, seed: int, ids: Sequence[str]) -> Column:
    """The hash of a row, then one of its other columns; maps have no hash and are left out."""
    others = [F.col(f.name) for f in df.schema if f.name not in ids and "map<" not in f.dataType.simpleString()]
    key = shuffle_key(seed, ids)
    if not others:
        return key
    # The hash of a null is that of nothing, so nulls are marked.
    rest = F.xxhash64(*[c.isNull() for c in others], *others)
    return F.concat(key, F.lpad(F.hex(rest), 16, "0"))


def _first_rows(df: DataFrame, key: Column, cutoff: Row, name: str) -> DataFrame:
    """Add ``name``: whether a row stands before the cutoff or is one of the tied rows to take."""
    if cutoff.take == cutoff.ties:
        return df.withColumn(name, key <= cutoff.key)
    tied = number_as_stored(df.filter(key == cutoff.key), "_place")
    return (
        df.filter(key != cutoff.key).withColumn(name, key < cutoff.key)
        .unionByName(tied.withColumn(name, F.col("_place") < cutoff.take).drop("_place"))
    )


def sample_exact(
    df: DataFrame, max_samples: int | None, seed: int = SEED, ids: Sequence[str] = ORDER
) -> DataFrame:
    """Exactly ``max_samples`` rows by hash order; all rows when not set or not exceeded."""
    if not max_samples:
        return df
    key = full_key(df, seed, ids)
    cutoff = smallest_cutoff(df.select(key.alias("key")), max_samples).first()
    if cutoff is None:
        return df
    return _first_rows(df, key, cutoff, "_taken").filter("_taken").drop("_taken")


def split_exact(
    df: DataFrame,
    eval_share: float = EVAL_SHARE,
    seed: int = SEED,
    ids: Sequence[str] = ORDER,
) -> DataFrame:
    """Add ``split``: the first ceil(share * rows) rows by hash order are "eval", the rest "train"."""
    key = full_key(df, seed, ids)
    wanted = F.ceil(F.lit(float(eval_share)) * F.col("total"))
    cutoff = smallest_cutoff(df.select(key.alias("key")), wanted).first()
    if cutoff is None:
        return df.withColumn("split", F.lit("train"))
    marked = _first_rows(df, key, cutoff, "_eval")
    return marked.withColumn("split", F.when(F.col("_eval"), "eval").otherwise("train")).drop("_eval")


def split_by_share(
    df: DataFrame, eval_share: float = EVAL_SHARE, seed: int = SEED, ids: Sequence[str] = ORDER
) -> DataFrame:
    """Add ``split``: a row is "eval" if its hash is below the share of all hash values.

    One pass and no state: a row's part depends on its ids alone, so it stays the same when
    rows come or go, and the DataFrame may be a stream. Of n rows share * n are expected in
    "eval", with a standard deviation of sqrt(share * (1 - share) * n).
    """
    place = F.conv(F.substring(shuffle_key(seed, ids), 1, 8), 16, 10).cast("bigint")
    below = place < int(eval_share * (1 << 32))
    return df.withColumn("split", F.when(below, "eval").otherwise("train"))


def split_sizes(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count("*").alias("n_rows"))


def write_split(split: DataFrame, path: str) -> None:
    """One directory per split; what an earlier run left there goes."""
    split.write.mode("overwrite").partitionBy("split").parquet(path)
