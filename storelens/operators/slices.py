"""Rows cut into slices of a sort order, inside the plan.

A sample of the rows, chosen by a hash of their sort key, gives evenly spaced split keys; a row's slice is
how many split keys it has reached, found by binary search. Splitting is by the whole key with its unique
last column, so a value shared by a third of all rows is cut up like any other; a null counts as the smallest
value. The split keys are a scalar subquery, chosen by content alone: a task that runs again finds the
same slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sampled rows per slice. They set only where to split.
SAMPLED = 32
# Sampling goes by the low bits of a hash.
_RANGE = 1 << 30


def sample_place(keys: list[str], draw: int = 0) -> Column:
    """A row's place from 0 to 1 in one of many draws, the same wherever the row is read."""
    return F.pmod(F.xxhash64(F.xxhash64(*keys), F.lit(draw)), F.lit(_RANGE)) / _RANGE


def packed(keys: list[str]) -> Column:
    """The sort key of a row as one struct."""
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])


def sliced(df: DataFrame, keys: list[str], name: str, slices: int) -> DataFrame:
    """``df`` and a column ``name``: the slice of each row, 0 to ``slices - 1``."""
    rows = df.agg(F.count("*").alias("rows")).scalar()
    near = df.withColumn("_rows", rows).where(sample_place(keys) * F.col("_rows") < SAMPLED * slices)
    ordered = near.agg(F.collect_list(packed(keys)).alias("s")).select(F.sort_array("s").alias("s"))
    step = F.floor(F.size("s") / slices) + 1
    splits = ordered.select(F.filter("s", lambda _, i: (i + 1) % step == 0)).scalar()
    row = packed(keys)
    powers = [1 << p for p in reversed(range(max(slices - 1, 1).bit_length()))]
    # A lambda can't hold a subquery; as a column that is read once, it moves into it unwritten.
    number = F.aggregate(
        F.array(*[F.lit(p) for p in powers]),
        F.struct(F.lit(0).alias("at"), F.col("_splits").alias("splits")),
        lambda a, p: F.struct(
            F.when(F.get(a["splits"], a["at"] + p - 1) <= row, a["at"] + p).otherwise(a["at"]).alias("at"), a["splits"].alias("splits")
        ),
        lambda a: a["at"],
    )
    return df.withColumn("_splits", splits).select(*[F.col(f"`{c}`") for c in df.columns], number.alias(name))
