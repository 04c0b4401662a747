"""Small helpers of the operators."""

from __future__ import annotations

import ctypes
import warnings
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.session import write_once

__all__ = ["apart", "column", "hashed_sample", "only", "plain_key", "secret_of", "table", "tidy", "tokenizer_path", "write_once"]

# Names the setting that holds the key of pseudonyms; a real run sets its own.
SECRET_SETTING, SECRET = "spark.storelens.pii.secret", "change me"


def column(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def only(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns alone, so that further columns of the caller never clash with ours."""
    return df.select(*[column(n) for n in names])


def apart(df: DataFrame, name: str) -> str:
    """A name like ``name`` that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def plain_key(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with long key columns passed through an expression, so that a join deals its rows out anew.

    AQE splits a skewed key only where both sides of a join are plain shuffles. An aggregate by the key is
    dealt by it already and would be joined as it is; its few rows go through one more shuffle instead.
    """
    return df.withColumns({k: F.expr(f"`{k}` ^ 0L") for k in keys})


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, and at a task's end its worker hands freed memory back. Workers live on between tasks and stages."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return tidied


def hashed_sample(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """At most ``rows`` rows of ``df``, those with the smallest hashes of ``keys``.

    Rows far beyond the bound are passed over where they are read, so that what meets in the one task
    that sorts is about the bound itself, not the bound times the number of tasks.
    """
    share = min(1.0, (1.5 * rows + 1000) / max(df.count(), 1))
    hashed = F.xxhash64(*[column(k) for k in keys])
    near = df.where(F.pmod(F.xxhash64(hashed), F.lit(1 << 30)) < int(share * (1 << 30)))
    return near.orderBy(hashed, *[column(c) for c in df.columns]).limit(rows)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def secret_of(spark: SparkSession) -> str:
    """The key of pseudonyms; a run without its own is warned that a public one is taken."""
    secret = spark.conf.get(SECRET_SETTING, "")
    if not secret:
        warnings.warn(f"{SECRET_SETTING} is not set: pseudonyms under the public default key can be undone", stacklevel=2)
    return secret or SECRET


def tokenizer_path() -> str:
    """The vocabulary that sequences are packed for; every executor has it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
