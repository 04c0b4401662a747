"""Grouping by keys that are nearly as many as the rows, in tasks of bounded memory.

A plain grouping folds each input split in one hash table before the shuffle, and AQE merges what comes out by its
bytes; where nothing folds, both hold as many groups as the split or the merged partition has rows. Here rows go by
their key to as many tasks as they need. A key with very many rows is told by a sample of the rows and is still
folded before the shuffle. The sample sets only which way a key goes: every row is counted.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows that a task may group, and how many of as many rows of one key the sample should hold.
TASK_ROWS, SAMPLED = 250_000, 20


def folded(df: DataFrame, key: list[str], aggregates: list[Column], rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df.groupBy(*key).agg(*aggregates)`` for about ``rows`` rows; ``rows`` sets only the number of tasks."""
    if rows <= 4 * task_rows:
        return df.groupBy(*key).agg(*aggregates)
    mark = F.xxhash64(*key)
    near = df.select(mark.alias("mark")).sample(min(1.0, SAMPLED / task_rows), seed=7)
    often = [r["mark"] for r in near.groupBy("mark").agg(F.count("*").alias("n")).where(F.col("n") >= SAMPLED / 2).collect()]
    tasks = max(ceil(rows / task_rows), df.sparkSession.sparkContext.defaultParallelism)

    def dealt(part: DataFrame) -> DataFrame:
        return part.repartition(tasks, *key).groupBy(*key).agg(*aggregates)

    if not often:
        return dealt(df)
    return dealt(df.where(~mark.isin(often))).unionByName(df.where(mark.isin(often)).groupBy(*key).agg(*aggregates))
