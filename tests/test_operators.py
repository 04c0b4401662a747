import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.operators import date_dim, demand_forecast, fill_days, next_in_group, two_proportion_test
from storelens.operators.folds import folded


@pytest.fixture(scope="module")
def orders(spark):
    """Customer 0 holds a third of the rows; several rows share a time."""
    return (
        spark.range(3000)
        .selectExpr(
            "id",
            "if(id % 3 = 0, 0, id % 50) as customer",
            "timestampadd(minute, cast(hash(id) % 40000 as int) div 7 * 7, timestamp_ntz'2025-01-01 00:00:00') as ts",
        )
        .cache()
    )


@pytest.mark.parametrize("slices", [None, 1, 2, 40])
def test_next_in_group_matches_lead(orders, slices):
    got = next_in_group(orders, "customer", "ts", "id", "n", slices)
    want = F.lead("ts").over(Window.partitionBy("customer").orderBy("ts", "id"))
    both = got.withColumn("w", want)
    assert both.count() == 3000
    assert both.where("not (n <=> w)").count() == 0


def test_one_customer_in_one_month_fills_no_task(spark):
    """A third of the rows belong to one customer and one second; no task takes twice the median."""
    rows = spark.range(60_000).selectExpr(
        "id", "if(id % 3 = 0, 0, id) as customer", "if(id % 3 = 0, timestamp_ntz'2025-01-01', timestampadd(minute, id % 977, timestamp_ntz'2025-01-01')) as ts"
    )
    led = next_in_group(rows, "customer", "ts", "id", "n", 32).withColumn("task", F.spark_partition_id())
    sizes = sorted(r["count"] for r in led.groupBy("task").count().collect())
    assert len(sizes) >= 30 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    heavy = led.where("customer = 0")
    assert heavy.where("n is null").count() == 1 and heavy.count() == 20_000


def test_next_of_empty_and_single_rows(spark):
    df = spark.createDataFrame([(1, 5, dt.datetime(2025, 1, 1))], "id int, k int, ts timestamp_ntz")
    assert next_in_group(df, "k", "ts", "id", "n", 9).collect()[0]["n"] is None
    assert next_in_group(df.limit(0), "k", "ts", "id", "n").count() == 0


def test_rows_without_a_time_come_first(spark):
    rows = [(1, 1, None), (2, 1, None), (3, 1, dt.datetime(2025, 1, 2)), (4, 1, dt.datetime(2025, 3, 2))]
    got = {r["id"]: r["n"] for r in next_in_group(spark.createDataFrame(rows, "id int, k int, ts timestamp_ntz"), "k", "ts", "id", "n").collect()}
    assert got == {1: None, 2: dt.datetime(2025, 1, 2), 3: dt.datetime(2025, 3, 2), 4: None}


def test_null_key_is_a_plain_group(spark):
    rows = [(1, None, dt.datetime(2025, 1, 1)), (2, None, dt.datetime(2025, 1, 2)), (3, 5, dt.datetime(2025, 1, 3))]
    df = spark.createDataFrame(rows, "id int, k int, ts timestamp_ntz")
    got = {r["id"]: r["n"] for r in next_in_group(df, "k", "ts", "id", "n").collect()}
    assert got == {1: dt.datetime(2025, 1, 2), 2: None, 3: None}


def _reference_fit(counts, horizon=28):
    """Least squares on the full design: intercept, trend, weekly waves and weekday indicators."""
    n = len(counts)
    def design(days):
        waves = [np.sin(2 * np.pi * days / 7), np.cos(2 * np.pi * days / 7)]
        weekdays = [(days % 7 == w).astype(float) for w in range(1, 7)]
        return np.column_stack([np.ones(len(days)), days, *waves, *weekdays])
    x, y = design(np.arange(n, dtype=float)), np.array(counts, dtype=float)
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    spread = np.std(y - x @ beta, ddof=x.shape[1])
    ahead = np.maximum(0, design(np.arange(n, n + horizon, dtype=float)) @ beta)
    return ahead, np.maximum(0, ahead - 1.96 * spread), ahead + 1.96 * spread


@pytest.mark.parametrize("length,drift", [(40, 0.5), (365, 0.0), (90, -0.6)])
def test_forecast_matches_least_squares(spark, length, drift):
    draw = np.random.default_rng(length)
    counts = [int(v) for v in np.maximum(0, draw.poisson(50, length) + drift * np.arange(length) + 6 * (np.arange(length) % 7 > 4))]
    first = dt.date(2025, 1, 1)
    df = spark.createDataFrame([(first + dt.timedelta(i), c) for i, c in enumerate(counts)], "d date, c bigint")
    got = demand_forecast(df, "d", "c").orderBy("forecast_date").collect()
    assert [r["forecast_date"] for r in got] == [first + dt.timedelta(length + i) for i in range(28)]
    for name, want in zip(("forecast_orders", "lower_95", "upper_95"), _reference_fit(counts)):
        assert [r[name] for r in got] == pytest.approx(list(np.round(want, 1)), abs=0.1000001)
        assert np.mean(np.abs(np.array([r[name] for r in got]) - np.round(want, 1)) > 1e-9) < 0.05


def test_forecast_without_degrees_of_freedom(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 1) + dt.timedelta(i), i) for i in range(10)], "d date, c int")
    rows = demand_forecast(df, "d", "c", horizon=7).collect()
    assert len(rows) == 7 and all(r["lower_95"] is None and r["upper_95"] is None for r in rows)


def test_fill_days(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 1), 3), (dt.date(2025, 1, 4), 2)], "d date, c int")
    got = [(r["d"].day, r["c"]) for r in fill_days(df, "d", "c").orderBy("d").collect()]
    assert got == [(1, 3), (2, 0), (3, 0), (4, 2)]


def test_date_dim(spark):
    bounds = spark.createDataFrame([(dt.date(2025, 1, 1), dt.date(2026, 1, 31))], "first_day date, last_day date")
    rows = date_dim(bounds).orderBy("date").collect()
    assert len(rows) == 396
    assert rows[3].asDict() == dict(
        date=dt.date(2025, 1, 4), year=2025, month_number=1, month="Jan", year_month="2025-01", weekday_number=6,
        weekday="Sat", is_weekend=True,
    )


@pytest.mark.parametrize("counts", [(120, 400, 150, 410), (116667, 416668, 133333, 416666), (5, 10, 5, 10)])
def test_two_proportions(spark, counts):
    df = spark.createDataFrame([counts], "xa bigint, na bigint, xb bigint, nb bigint")
    z, p = two_proportion_test(*(F.col(c) for c in ("xa", "na", "xb", "nb")))
    row = df.select(z.alias("z"), p.alias("p")).first()
    xa, na, xb, nb = counts
    common = (xa + xb) / (na + nb)
    want = (xb / nb - xa / na) / math.sqrt(common * (1 - common) * (1 / na + 1 / nb))
    assert row["z"] == pytest.approx(want, rel=1e-12)
    assert row["p"] == pytest.approx(math.erfc(abs(want) / math.sqrt(2)), abs=1e-12)


def test_two_proportions_agree_with_permutations(spark):
    df = spark.createDataFrame([(30, 200, 48, 200)], "xa int, na int, xb int, nb int")
    _, p = two_proportion_test(*(F.col(c) for c in ("xa", "na", "xb", "nb")))
    draw = np.random.default_rng(3)
    shuffled = draw.hypergeometric(78, 322, 200, size=100_000)
    share = np.mean(np.abs((78 - shuffled) - shuffled) >= 18)
    assert df.select(p.alias("p")).first()["p"] == pytest.approx(share, abs=0.02)


def test_two_proportions_with_an_empty_side(spark):
    df = spark.createDataFrame([(0, 0, 5, 10)], "xa int, na int, xb int, nb int")
    z, p = two_proportion_test(*(F.col(c) for c in ("xa", "na", "xb", "nb")))
    assert tuple(df.select(z, p).first()) == (None, None)


def test_grouping_by_nearly_unique_keys_takes_tasks_by_rows_and_folds_a_common_key_first(spark):
    rows = spark.range(40_000, numPartitions=4).selectExpr("if(id % 4 = 0, null, id) as a", "cast(id % 7 as string) as b", "id as v")
    aggregates = [F.count("*").alias("n"), F.sum("v").alias("v")]
    got = folded(rows, ["a"], aggregates, rows=40_000, task_rows=500)
    want = rows.groupBy("a").agg(*aggregates)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    both = folded(rows, ["a", "b"], aggregates, rows=40_000, task_rows=500)
    assert sorted(map(str, both.collect())) == sorted(map(str, rows.groupBy("a", "b").agg(*aggregates).collect()))
    # Unique keys are grouped behind the shuffle alone, in 80 tasks; the null key is folded before one.
    unique = folded(rows.where("v % 4 > 0"), ["a"], aggregates, rows=40_000, task_rows=500)
    assert sorted(map(str, unique.collect())) == sorted(map(str, want.where("a is not null").collect()))
    assert unique.rdd.getNumPartitions() == 80
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "ENSURE_REQUIREMENTS" not in plan(unique) and "Union" not in plan(unique) and "Union" in plan(got)
