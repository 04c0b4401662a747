"""Next event of the same key, safe for keys that hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.operators.slices import packed, sliced


def next_in_group(df: DataFrame, key: str, ts: str, unique: str, name: str, slices: int | None = None) -> DataFrame:
    """Add column ``name``: the ``ts`` of the next row of the same ``key``, ordered by ``ts, unique``.

    All rows are cut into slices of the order ``key, ts, unique``, one task each, whatever share of them one
    key or one moment holds; the number of slices is that of shuffle partitions unless it is given. Within
    a slice a plain ``lead`` finds the next row. The last row of a slice takes the head of the next
    slice instead: heads are one row per slice, so they are broadcast. Nulls sort first, a null key is a key.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [key, ts, unique]
    cut = sliced(df, keys, "_slice", slices)
    heads = cut.groupBy("_slice").agg(F.min(packed(keys)).alias("_head")).select(
        F.lead("_slice").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("_slice"))).alias("_before"), "_head"
    )
    # The slice number is the partition: no hash that would put two slices into one task and none into another.
    order = Window.partitionBy("_slice").orderBy(key, ts, unique)
    led = cut.repartitionById(slices, F.col("_slice")).withColumn("_next", F.lead(packed(keys)).over(order))
    last = F.col("_next").isNull()
    carried = led.join(F.broadcast(heads), last & (F.col("_slice") == F.col("_before")), "left")
    following = F.coalesce("_next", "_head")
    same = F.col(key).eqNullSafe(following["k0"]) & following.isNotNull()
    return carried.select(*df.columns, F.when(same, following["k1"]).alias(name))
