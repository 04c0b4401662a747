import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from corner import documents, empty
from pyspark.sql import functions as F

from conftest import DATA
from storelens.llm import near_dup
from storelens.llm.components import components
from storelens.llm.shared import plain_key, write_once


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k:k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute_force(rows, percent=85):
    """Smallest reachable id of each id, from all pairs that share a rare shingle."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    df = Counter(s for m in sets.values() for s in m)
    index = defaultdict(list)
    for i in sorted(sets, key=lambda i: len(sets[i])):
        mine = sorted(sets[i], key=lambda s: (df[s], s))
        for s in mine[:len(mine) * (100 - percent) // 100 + 1]:
            for j in index[s]:
                both = len(sets[i] & sets[j])
                if find(i) != find(j) and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((find(i), find(j)))
                    parent[b] = a
            index[s].append(i)
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def got(df):
    return [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()]


def edited(words, n, rng):
    words = list(words)
    for k in rng.sample(range(len(words)), n):
        words[k] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def edits():
    """A base text of 150 words with copies of one to six changed words, so similarities lie around the limit."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = [(1000 + k, edited(base, rng.randrange(1, 7), rng)) for k in range(250)]
    rows += [(2000 + k, " ".join(f"v{rng.randrange(10**5)}" for _ in range(120))) for k in range(50)]
    return rows


def test_components_equal_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    root, size = brute_force([(r["doc_id"], r["text"]) for r in docs.collect()])
    result = got(near_dup.near_duplicates(docs))
    assert sorted(result) == sorted((i, size[i], root[i], i == root[i]) for i in root)


@pytest.mark.parametrize("block,percent", [(near_dup.BLOCK, 85), (45_000, 85), (20_000, 80), (5_000, 85)])
def test_similarities_around_the_limit_also_over_several_blocks(spark, edits, monkeypatch, block, percent):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    root, _ = brute_force(edits, percent)
    result = {r[0]: r[2] for r in got(near_dup.near_duplicates(spark.createDataFrame(edits, "doc_id long, text string"), percent))}
    assert result == root
    assert len(set(root.values())) > 55


def test_corner_rows(spark):
    result = got(near_dup.near_duplicates(documents(spark)))
    assert len(result) == 10
    by_id = {r[0]: r[1:] for r in result}
    assert by_id[1] == (0, 1, True) and by_id[2] == (0, 2, True) and by_id[3] == (0, 3, True)
    assert by_id[4] == (1, 4, True) and by_id[6] == (4, 6, True) and by_id[7] == (4, 6, False)
    assert sorted(r[1:] for r in result if r[0] is None) == [(0, None, True), (3, None, True)]
    assert got(near_dup.near_duplicates(empty(spark))) == []


def test_one_of_each_keeps_all_columns_and_one_of_repeated_rows(spark):
    docs = documents(spark)
    kept = near_dup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 0), (False, 0)] + [(True, i) for i in (1, 2, 3, 4, 5, 6)]
    assert near_dup.one_of_each(empty(spark)).count() == 0


def test_registers_merge_and_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(1)
    both, left, right = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    a, b = np.concatenate([both, left]), np.concatenate([both, right])
    ka, kb, kab = near_dup.sketches([a, b, np.concatenate([a, b])])
    assert (np.maximum(ka, kb) == kab).all()
    equal, above = (ka == kb).sum(), (ka > kb).sum()
    estimate = near_dup.joint_estimate(equal, above, near_dup.REGISTERS - equal - above, 0.5, 0.5)
    assert abs(estimate - 0.8) < 0.08


def test_components_of_chains_stars_and_loops(spark):
    links = [(k + 1, k) for k in range(100, 160)] + [(5, k) for k in range(6, 40)] + [(70, 71), (71, 72), (72, 70), (90, 90), (None, 3)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert found == {**{k: 100 for k in range(100, 161)}, **{k: 5 for k in range(5, 40)}, 70: 70, 71: 70, 72: 70}


def test_bands_follow_the_threshold():
    assert [near_dup.rows_per_band(p) for p in (95, 85, 80, 70)] == [8, 8, 6, 4]


def test_another_text_under_an_id_is_another_document(spark):
    rows = [(1, "one text of some words that stands alone here"), (1, "a quite different one which has nothing in common"), (1, "one text of some words that stands alone here"),
            (2, "one text of some words that stands alone here"), (3, None), (3, None)]
    left = near_dup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in left) == [(1, rows[1][1]), (1, rows[0][1]), (3, "")]


def test_columns_of_the_caller_stay_as_they_are(spark):
    docs = documents(spark)
    left = near_dup.one_of_each(docs)
    assert left.columns == docs.columns
    assert {tuple(r)[2:] for r in left.collect()} == {tuple(r)[2:] for r in docs.collect()}


def test_a_hub_is_split(spark):
    """The minima meet the links through a shuffle of their own, so AQE can split a node with most of the links."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "24",
            "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        links = spark.range(40_000).selectExpr("id as a", "if(id % 2 = 0, 50000L, 60000L + id) as b").repartition(8)
        table = write_once(links.selectExpr("b as u", "a as v"), "hub-links")
        joined = table.join(plain_key(table.groupBy("u").agg(F.min("v").alias("m")), "u"), "u").select("v", "m").distinct()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        roots = {r["node"]: r["root"] for r in components(links, "a", "b").collect()}
        assert len(roots) == 60_001 and all(roots[i] == (0 if i % 2 == 0 else i) for i in range(40_000)) and roots[50_000] == 0
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
