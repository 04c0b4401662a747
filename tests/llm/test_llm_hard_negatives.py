import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from storelens.llm import hard_negatives as hard

SCHEMA = "vec_id long, embedding array<float>, label int, id string, x int, y int, norm string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "i", 1, 2, "n", 3) for i, v, label in rows], SCHEMA)


def brute(rows, positives=5, negatives=10):
    """Every pair scored in Python's integers, row by row."""
    once = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        once[i] = min(once.get(i, (label, q)), (label, q))
    out = []
    for a, (label, q) in once.items():
        if a % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, r)), i, other) for i, (other, r) in once.items() if i != a and len(r) == len(q)))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            found = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(found)]
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in hard.hard_negatives(df, F.col("vec_id") % 100 == 0).collect())


def clustered(n, size, seed):
    made = np.random.default_rng(seed)
    centres = made.normal(size=(6, size))
    vectors = centres[made.integers(0, 6, n)] + 0.4 * made.normal(size=(n, size))
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def test_equal_to_brute_force_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard, "ROWS", 150)
    monkeypatch.setattr(hard, "ANCHORS", 4)
    vectors = clustered(1201, 12, 5)
    vectors[300:420] = vectors[300]  # copies: ties by id, more than are asked for
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(vectors, np.random.default_rng(6).integers(0, 4, 1201)))]
    got = mined(frame(spark, rows))
    assert got == brute(rows) and len({r[0] for r in got}) > 8


def test_bounds_hold_and_pass_rows_over():
    vectors = np.floor(256 * clustered(600, 24, 7).astype(float))
    vectors[5], vectors[6], vectors[8] = 0, vectors[7] * 1000, -vectors[7]
    norms = np.linalg.norm(vectors, axis=1)
    references = hard.reference_directions(vectors)
    assert references.shape == (hard.REFERENCES, 24)
    angles, passed = hard.angles_to(references, vectors, norms), 0
    for i in range(0, 600, 7):
        lower, upper = hard.score_bounds(angles[i], norms[i], angles, norms)
        scores = hard.exact_scores(vectors[i].astype(np.int64), vectors.astype(np.int64), norms[i] * norms.max())
        assert (lower <= scores).all() and (scores <= upper).all()
        passed += int((upper < scores[np.argsort(scores)[-20]]).sum())
    assert passed > 1000
    none = hard.score_bounds(np.empty(0), 3.0, np.empty((2, 0)), np.array([1.0, 2.0]))
    assert none[0].tolist() < [-3.0, -6.0] and (none[1] > [3.0, 6.0]).all()


def test_corner_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [0.5, 0.5], 1), (1, [0.9, 0.1], 1), (1, [0.9, 0.1], 1), (2, [0.5, 0.4], 2), (3, [0.5, 0.4], 2),
        (4, None, 2), (5, [0.5, None], 2), (6, [nan, 0.1], 2), (7, [inf, 0.1], 2), (8, [], 2), (9, [0.5, 0.4, 0.3], 2), (10, [0.5, 0.4], None),
        (None, [0.5, 0.4], 2), (11, [0.0, 0.0], 2), (12, [-0.5, -0.4], 2), (100, [0.5, 0.4, 0.3], 1), (101, [0.5, 0.4, 0.3], 1),
        (200, [0.0, 0.0], 1), (300, None, 1), (-100, [-0.9, 0.2], 2), (13, [3e7, 1.0], 2),
    ]
    df = frame(spark, rows)
    got = mined(df)
    assert got == brute([r for r in rows if r[0] != 13])
    assert {r[0] for r in got} == {-100, 0, 200} and {r[1] for r in got} <= {r[0] for r in rows}
    assert mined(df.limit(0)) == []
    assert hard.hard_negatives(df, F.lit(None).cast("boolean")).count() == 0
    words = hard.hard_negatives(df, F.col("vec_id") % 100 == 0, label=F.concat(F.lit("k"), F.col("label")))
    assert sorted(tuple(r) for r in words.collect()) == got


def test_large_products_stay_exact():
    anchor, rows = np.array([2 ** 30, 3], np.int64), np.array([[2 ** 29, 1], [2 ** 29, 2]], np.int64)
    assert hard.exact_scores(anchor, rows, 2.0 ** 59).tolist() == [2 ** 59 + 3, 2 ** 59 + 6]


@pytest.mark.parametrize("folder", ["sf0.001"])
def test_whole_small_table(spark, folder):
    from storelens.llm.queries import QUERIES

    table = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    rows = [(i, v, (k + 1) % 10 if i % 7 == 0 and k is not None else k) for i, v, k in table]
    got = QUERIES["op11_hard_negatives"](spark, f"/root/testdata/{folder}").collect()
    assert sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in got) == brute(rows)
