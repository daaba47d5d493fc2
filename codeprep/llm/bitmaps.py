"""Bitmaps of hashes, of a fixed size, that spare rows a shuffle and never decide alone."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """Bits of the first ``BITS`` bits of all hashes; at most 2^19 rows of 12 bytes come to the driver."""
    first = F.shiftrightunsigned(column, 64 - BITS)
    rows = (
        hashes.select(F.shiftright(first, 5).cast("int").alias("place"), (first % 32).cast("int").alias("bit"))
        .groupBy("place")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .toArrow()
    )
    words = np.zeros(1 << (BITS - 5), "<u4")
    words[rows["place"].to_numpy()] = rows["bits"].to_numpy()
    return words.view(np.uint8)


def held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the unsigned hashes may be in the bitmap."""
    at = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0


def parted(
    documents: DataFrame, key: Column, names: Sequence[Column], listed: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The rows whose names are those of a row of ``listed``, and all others.

    ``listed`` holds ``key``, a hash, and the names, by position; nulls equal nulls. Rows outside
    the bitmap of the listed keys stay where they are; only the others are joined. As the list
    grows the bitmap lets more rows through to the join. A null key is not listed. Columns of
    the rows may have any name.
    """
    spark = documents.sparkSession
    listed = listed.toDF(*[f"_{uuid.uuid4().hex}" for _ in listed.columns])
    bits = spark.sparkContext.broadcast(bitmap(listed, listed.columns[0]))

    @F.pandas_udf("boolean")
    def may_be_listed(keys: pd.Series) -> pd.Series:
        known = keys.notna().to_numpy()
        values = keys.fillna(0).to_numpy(np.int64).view(np.uint64)
        return pd.Series(known & held(bits.value, values))

    doubtful = documents.filter(may_be_listed(key))
    same = key == F.col(listed.columns[0])
    for name, column in zip(names, listed.columns[1:]):
        same &= name.eqNullSafe(F.col(column))
    others = documents.filter(~may_be_listed(key)).unionByName(doubtful.join(listed, same, "left_anti"))
    return doubtful.join(listed, same, "left_semi"), others
