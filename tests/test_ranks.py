import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.operators import percentiles, rows_at_ranks, tiles
from storelens.operators.ranks import Key, _tile_starts

# A third of all rows share one value, so a split by value alone would not narrow.
HEAVY = [7] * 1000


def values(n=3000, seed=1):
    draw = random.Random(seed)
    body = HEAVY + [draw.randrange(0, 400) for _ in range(n - len(HEAVY))]
    draw.shuffle(body)
    return body


def values_of(spark, columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, v, Decimal(v) / 4) for i, v in enumerate(values())]
    return spark.createDataFrame(rows, "id bigint, v bigint, m decimal(18,2)").cache()


@pytest.mark.parametrize("small", [None, 1, 100])
@pytest.mark.parametrize("descending", [False, True])
def test_ntile_matches_window(table, small, descending):
    key = Key("v", descending)
    got = tiles(table, {"t": ([key, "id"], 5, "ntile")}, small)
    want = F.ntile(5).over(Window.orderBy(F.desc("v") if descending else F.asc("v"), "id"))
    assert got.withColumn("w", want).where("t <> w").count() == 0


@pytest.mark.parametrize("small", [None, 1, 100])
def test_qcut_matches_pandas(table, small):
    got = tiles(table, {"t": (["m", "id"], 5, "qcut")}, small).orderBy("id").toPandas()
    frame = pd.DataFrame({"v": values()})
    want = pd.qcut(frame["v"].rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert list(got["t"]) == list(want)


@pytest.mark.parametrize("n", [1, 2, 5, 7, 99, 101])
def test_tiles_of_few_rows(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k").cache()
    got = [r["t"] for r in tiles(df, {"t": (["k"], 5, "ntile")}).orderBy("k").collect()]
    assert got == [r["t"] for r in df.withColumn("t", F.ntile(5).over(Window.orderBy("k"))).orderBy("k").collect()]
    if n > 1:
        cut = [r["t"] for r in tiles(df, {"t": (["k"], 5, "qcut")}).orderBy("k").collect()]
        assert cut == [max(1, -(-5 * (r - 1) // (n - 1))) for r in range(1, n + 1)]


def test_tile_starts_for_all_sizes():
    for n in range(5, 200):
        tile = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=False)
        starts = [int(np.argmax(tile.to_numpy() == t)) + 1 for t in range(1, 5)]
        assert _tile_starts(5, "qcut")(n) == starts


def test_keys_at_ranks_with_text_key(spark):
    rows = [("a" if i % 3 else "b", f"k{i:05d}") for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, k string").cache()
    ranks = [1, 2, 700, 1333, 1334, 2000]
    orders = {"up": (["g", "k"], lambda n: ranks), "down": ([Key("g", True), Key("k", True)], lambda n: [*ranks, n, n + 1])}
    ordered = sorted(rows)
    for small in (None, 50):
        found = {name: {r["rank"]: tuple(r["at"]) for r in frame.collect()} for name, frame in rows_at_ranks(df, orders, small).items()}
        assert found["up"] == {r: ordered[r - 1] for r in ranks}
        assert found["down"] == {r: ordered[::-1][r - 1] for r in ranks}


def test_keys_that_repeat_end_the_narrowing(spark):
    df = spark.createDataFrame([(5,)] * 300 + [(7,)] * 20, "v int")
    found = rows_at_ranks(df, {"v": (["v"], lambda n: [1, 300, 301, n])}, small=10)["v"].collect()
    assert sorted((r["rank"], r["at"]["k0"]) for r in found) == [(1, 5), (300, 5), (301, 7), (320, 7)]


@pytest.mark.parametrize("small", [None, 60])
def test_percentiles(spark, table, small):
    sparse = table.withColumn("s", F.when(F.col("id") % 7 == 0, F.col("v") / 3.0))
    got = values_of(spark, percentiles(sparse, {"v": 0.75, "m": 0.25, "s": 0.9}, ["id"], small))
    frame = sparse.toPandas()
    assert got["v"] == frame["v"].quantile(0.75)
    assert got["m"] == frame["m"].astype(float).quantile(0.25)
    assert got["s"] == pytest.approx(frame["s"].quantile(0.9), rel=1e-15)


def test_percentile_of_nothing(spark):
    df = spark.range(200).select("id", F.lit(None).cast("double").alias("x"))
    assert values_of(spark, percentiles(df, {"x": 0.5}, ["id"])) == {"x": None}
    assert values_of(spark, percentiles(df.limit(0), {"id": 0.5}, ["id"], small=10)) == {"id": None}


def test_jobs_do_not_grow_with_columns(spark, table):
    """Counting and cutting take the same jobs for one column and for three; thresholds stay in the plan."""
    tracker = spark.sparkContext.statusTracker()

    def jobs(wanted):
        before = len(tracker.getJobIdsForGroup(None))
        made = percentiles(table, wanted, ["id"])
        later = table.where(F.col("v").cast("double") >= made["v"])
        assert "scalar-subquery" in later._jdf.queryExecution().optimizedPlan().toString()
        return len(tracker.getJobIdsForGroup(None)) - before

    assert jobs({"v": 0.5, "m": 0.5, "id": 0.5}) <= jobs({"v": 0.5}) + 4
