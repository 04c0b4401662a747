import zlib

import numpy as np
import pytest
from corner import documents, empty
from pyspark.sql import functions as F

from conftest import DATA
from storelens.llm import toxicity as tox


@pytest.mark.parametrize("folder,least", [("sf0.1", 0.97)])
def test_held_out_accuracy(spark, folder, least):
    docs, labels = (spark.read.parquet(f"{DATA}/{folder}/{n}.parquet") for n in ("documents", "labels"))
    scored = tox.toxicity(docs, tox.fit(docs, labels)).withColumn("held_out", tox.held_out_rows(F.col("doc_id")))
    rows = scored.join(labels, "doc_id").where("held_out").select("doc_id", "score", "predicted", "toxic").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    toxic = [r for r in rows if r["toxic"] == 1]
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) >= least
    # A few labels of texts without any sign are noise.
    assert np.mean([r["predicted"] for r in toxic]) >= 0.9


def test_held_out_labels_are_never_read(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(tox.held_out_rows(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = tox.fit(docs, labels), tox.fit(docs, turned)
    assert a == b and a.terms


def test_folding():
    assert tox.fold("IDI0T, ｉｄｉｏｔ іdіоt 1d1ot") == " idiot  idiot idiot idiot "
    assert tox.fold("«Mor\u200bon» ‘scum’ Été") == "  moron   scum  été "
    assert tox.fold("") == "  "


def test_scores_of_a_given_lexicon():
    lexicon = tox.Lexicon({" trash": 6.0, " moron": 6.0}, bias=-4.0, slope=2.0)
    texts = ["you moron", "put it in the trash can", "a m0r0n in a long text " + "of words " * 400, None, "", "oxymoron"]
    strong, can, thin, null, blank, inner = lexicon.scores(texts)
    assert strong > 0.9 and strong > thin
    assert can == null == blank == inner == pytest.approx(1 / (1 + np.exp(4.0)))
    found = np.array([lexicon.strengths(["moron " + "word " * n])[0] for n in (1, 10, 100)])
    assert (np.diff(found) < 0).all()


def test_best_cut():
    x, y = np.array([0, 0, 0, 1, 2, 9, 8, 0.0]), np.array([0, 0, 0, 0, 0, 1, 1, 1])
    assert tox.best_cut(x, y, 1.0) == 5.0
    assert tox.best_cut(np.zeros(3), np.array([0, 1, 0]), 1.0) > 0


def test_corner_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    lexicon = tox.fit(docs, labels)
    result = tox.toxicity(docs, lexicon)
    assert result.columns == [*docs.columns, "predicted"]
    assert {r["predicted"] for r in result.collect()} <= {0, 1} and result.count() == 10
    none = tox.fit(docs, labels.limit(0))
    assert none.terms == {} and all(r["predicted"] == 0 for r in tox.toxicity(docs, none).collect())
    assert tox.toxicity(empty(spark), lexicon).count() == 0


def test_evidence_alone_decides(spark):
    # One toxic word is common, one stands in one toxic text of twenty: under any share or place in a list, and learned all the same.
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("rn", "lt", "mp", "sk", "nd")]
    say = lambda k, extra: " ".join([*(words[(k * 7 + i * 13 + i * k) % 100] for i in range(40)), *(x for e in extra for x in (words[(k // 20 * 37 + len(e)) % 100], e))])
    rows = [(k, say(k, ["snorkface"] if k % 20 else ["quibble"]), 1) for k in range(0, 400)]
    rows += [(k, say(k, []), 0) for k in range(1000, 2000)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    lexicon = tox.fit(docs, labels)
    assert {t.strip()[:3] for t in lexicon.terms} == {"sno", "qui"}
    rare = tox.toxicity(docs, lexicon).where("doc_id < 400 and doc_id % 20 = 0").collect()
    assert len(rare) == 20 and all(r["predicted"] == 1 for r in rare)


def test_surprise(spark):
    def plain(a, n, b, m):
        log = lambda k, total: k * np.log(k / total) if k else 0.0
        both = (a + b, n + m - a - b)
        return 2 * (log(a, n) + log(n - a, n) + log(b, m) + log(m - b, m) - log(both[0], n + m) - log(both[1], n + m))

    cases = [(5, 100, 0, 900), (0, 100, 7, 900), (100, 100, 0, 900), (30, 100, 270, 900), (100, 100, 900, 900), (0, 100, 0, 900)]
    df = spark.createDataFrame([(k, a, b) for k, (a, _, b, _) in enumerate(cases)], "k int, a long, b long")
    found = {r["k"]: r["s"] for r in df.select("k", tox.surprise(F.col("a"), 100, F.col("b"), 900).alias("s")).collect()}
    for k, case in enumerate(cases):
        assert found[k] == pytest.approx(plain(*case) if 0 < case[0] + case[2] < 1000 else 0.0, abs=1e-6)
