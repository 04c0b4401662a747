import zlib
from collections import Counter

import numpy as np
from corner import documents, empty
from pyspark.sql import functions as F

from conftest import DATA
from storelens.llm import language_id as lid


def runs(text):
    """Counts of runs of characters, one by one."""
    said = "".join(c.lower() if c.isalpha() else " " for c in text)
    said = " " + said
    while "  " in said:
        said = said.replace("  ", " ")
    return Counter(said[e - n + 1:e + 1] for n in (1, 2, 3) for e in range(max(1, n - 1), len(said)) if n > 1 or said[e] != " ")


def test_features_are_counts_of_runs(monkeypatch):
    text = "Été 12 où, l'été—Straße? ß x" * 5
    buckets, values = lid.features(text)
    counts = runs(text)
    assert len(buckets) <= len(counts) <= len(buckets) + 2
    assert np.isclose((values ** 2).sum(), 1.0)
    assert np.isclose(np.sqrt(max(counts.values()) / sum(counts.values())), values.max(), rtol=0.02)
    monkeypatch.setattr(lid, "PIECE", 7)
    pieces = lid.features(text)
    assert (pieces[0] == buckets).all() and np.allclose(pieces[1], values)
    for nothing in ("", "12 — !", " "):
        assert len(lid.features(nothing)[0]) == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet")
    model = lid.fit(docs)
    assert sorted(model.families.names) == ["germanic", "romance"]
    assert {f: c.names for f, c in model.languages.items()} == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    result = lid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in result)
    held = [r["lang_pred"] == r["lang"] for r in result if r["held_out"]]
    assert len(held) > 1000 and np.mean(held) >= 0.98


def test_held_out_rows_are_never_read(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    held = lid.held_out_rows(F.col("doc_id"))
    turned = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn("text", F.when(held, "x").otherwise(F.col("text")))
    a, b = lid.fit(docs, most=60, rounds=5), lid.fit(turned, most=60, rounds=5)
    assert a.families.names == b.families.names
    for pair, (weights, shift) in a.families.weights.items():
        assert np.allclose(weights, b.families.weights[pair][0]) and np.isclose(shift, b.families.weights[pair][1])


def test_most_contests_won_decide_then_margins_then_names():
    one = np.ones(1)
    at = np.zeros(1, int)
    won = lid.Contests(["a", "b", "c"], {("a", "b"): (one, 0.0), ("a", "c"): (one * 0.5, 0.0), ("b", "c"): (one, 0.0)})
    assert won.winner(at, one) == ("a", 1 / (1 + np.exp(-1.5)))
    tied = lid.Contests(["a", "b", "c"], {("a", "b"): (one, 0.0), ("a", "c"): (-one, 0.0), ("b", "c"): (2 * one, 0.0)})
    assert tied.winner(at, one)[0] == "b"
    assert lid.Contests(["b", "a"], {("b", "a"): (0 * one, 0.0)}).winner(at, one) == ("a", 0.5)
    assert lid.Contests(["only"]).winner(at, one) == ("only", 1.0)


def test_corner_rows(spark):
    docs = documents(spark)
    assert {r["lang_pred"] for r in lid.identify(docs, lid.fit(docs)).collect()} == {"und"}
    one = lid.fit(docs.withColumn("lang", F.lit("sv")))
    result = lid.identify(docs, one)
    rows = result.collect()
    assert result.columns == ["doc_id", "held_out", "lang_pred", "score"] and len(rows) == docs.count()
    blank = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert len(blank) == 3 and all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in blank)
    assert sum(r["lang_pred"] == "sv" and r["score"] == 1.0 for r in rows) == len(rows) - 4
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False, False]
    assert lid.identify(empty(spark), one).count() == 0
    assert lid.identify(docs, lid.fit(empty(spark))).count() == docs.count()
