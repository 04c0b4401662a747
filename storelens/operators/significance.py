"""Two-proportion test over aggregated rows."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def pooled_error(x_a: Column, n_a: Column, x_b: Column, n_b: Column) -> Column:
    """Standard error of the difference of two proportions under a common rate."""
    x_a, n_a, x_b, n_b = (c.cast("double") for c in (x_a, n_a, x_b, n_b))
    common = (x_a + x_b) / F.nullif(n_a + n_b, F.lit(0.0))
    return F.sqrt(common * (1 - common) * (1 / F.nullif(n_a, F.lit(0.0)) + 1 / F.nullif(n_b, F.lit(0.0))))


@F.pandas_udf(DoubleType())
def p_value(z: pd.Series) -> pd.Series:
    """Two-sided normal p-value. Neither Spark nor SQL has ``erfc``; this sees one row per test."""
    return z.map(lambda v: None if pd.isna(v) else math.erfc(abs(v) / math.sqrt(2)))


def two_proportion_test(x_a: Column, n_a: Column, x_b: Column, n_b: Column) -> tuple[Column, Column]:
    """z score of rate b over rate a, and its two-sided p-value. Null on an empty side or no spread."""
    lift = x_b.cast("double") / F.nullif(n_b.cast("double"), F.lit(0.0)) - x_a.cast("double") / F.nullif(
        n_a.cast("double"), F.lit(0.0)
    )
    z = lift / F.nullif(pooled_error(x_a, n_a, x_b, n_b), F.lit(0.0))
    return z, p_value(z)
