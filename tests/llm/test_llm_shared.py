import numpy as np
from pyspark.sql import functions as F

from storelens.llm.bloom import bloom, in_bloom, parted
from storelens.llm.shared import hashed_sample
from storelens.llm.words import U64


def test_a_filter_loses_nothing_and_lets_little_else_through(spark):
    hashes = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    words = bloom(hashes, "h")
    mine = hashes.toPandas()["h"].to_numpy().view(U64)
    others = spark.range(50_000, 90_000).select(F.xxhash64("id").alias("h")).toPandas()["h"].to_numpy().view(U64)
    assert in_bloom(words, mine).all() and in_bloom(words, others).mean() < 0.05
    assert not in_bloom(bloom(hashes.limit(0), "h"), mine).any()
    assert in_bloom(words, np.empty(0, U64)).tolist() == []


def test_both_parts_make_up_the_whole(spark):
    rows = spark.range(5000)
    sure, rest = parted(rows, F.xxhash64("id"), spark.range(100).select(F.xxhash64("id").alias("h")), "h")
    a, b = ({r["id"] for r in part.collect()} for part in (sure, rest))
    assert not a & b and len(a) + len(b) == 5000 and set(range(100)) <= b and len(b) < 300


def test_a_sample_has_its_bound_and_does_not_depend_on_partitions(spark):
    rows = spark.range(30_000).selectExpr("id", "id % 7 as v")
    first = sorted(r["id"] for r in hashed_sample(rows, ["id"], 500).collect())
    assert len(first) == 500 and len(set(first)) == 500
    assert first == sorted(r["id"] for r in hashed_sample(rows.repartition(13), ["id"], 500).collect())
    assert hashed_sample(rows.limit(20), ["id"], 500).count() == 20
    assert hashed_sample(rows.limit(0), ["id"], 500).count() == 0
