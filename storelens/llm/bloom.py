"""Bloom filters of bounded size that sift rows before a shuffle. The join behind them stays exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.words import U64

# Bits of a filter: sixteen per entry, at most 4 MB; beyond that it sifts less, results stay the same.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 25


def _probes(value: Column, bits: int) -> Column:
    return F.array(value.bitwiseAND(bits - 1), F.shiftrightunsigned(value, 32).bitwiseAND(bits - 1))


def bloom(values: DataFrame, name: str) -> np.ndarray:
    """A Bloom filter of a long column as 64-bit words; ``len * 64`` bits, a power of two."""
    bits = LEAST_BITS
    entries = values.count()
    while bits < min(16 * entries, MOST_BITS):
        bits *= 2
    bit = values.select(F.explode(_probes(F.col(name), bits)).alias("bit"))
    # At most bits / 64 rows, whatever the number of values.
    rows = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")
    ).collect()
    words = np.zeros(bits // 64, np.int64)
    for row in rows:
        words[row["word"]] = row["mask"]
    return words.view(U64)


def in_bloom(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    low = U64(len(words) * 64 - 1)
    found = np.ones(len(hashes), bool)
    for bit in (hashes & low, (hashes >> U64(32)) & low):
        found &= (words[bit >> U64(6)] >> (bit & U64(63)) & U64(1)).astype(bool)
    return found


def parted(df: DataFrame, key: Column, values: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose ``key`` is surely not among the values of column ``name``, and the rest.

    ``key`` and the values are 64-bit hashes.
    """
    shared = df.sparkSession.sparkContext.broadcast(bloom(values, name))

    @F.arrow_udf("boolean")
    def may_be(hashes: pa.Array) -> pa.Array:
        return pa.array(in_bloom(shared.value, hashes.to_numpy(zero_copy_only=False).astype(np.int64).view(U64)))

    return df.where(~may_be(key)), df.where(may_be(key))


def sift(df: DataFrame, key: Column, values: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be among the values; no row that has a match is lost."""
    return parted(df, key, values, name)[1]
