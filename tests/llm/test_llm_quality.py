import re

import numpy as np
from corner import documents, empty

from conftest import DATA
from storelens.llm.quality import Forest, best_threshold, judge, rule_counts


def brute_force(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = {}
    for i in range(len(w) - 4):
        places.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def counts(r):
    return r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]


def test_counts_equal_brute_force_and_verdicts_follow_labels(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/sf0.1/labels.parquet")
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.limit(1500).collect()}
    good = bad = lost = missed = 0
    for r in judge(docs, labels).collect():
        if r["doc_id"] in texts:
            assert counts(r) == brute_force(texts[r["doc_id"]])
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
        if r["doc_id"] in quality and not r["base_failed"]:
            good += quality[r["doc_id"]] == 1
            bad += quality[r["doc_id"]] == 0
            lost += quality[r["doc_id"]] == 1 and not r["kept"]
            missed += quality[r["doc_id"]] == 0 and r["kept"]
    assert good > 3000 and bad > 200
    assert lost <= 0.01 * good and missed <= 0.02 * bad


def test_odd_texts(spark):
    texts = ["a b a b a b a b a b a b", "x\nx\n\n \nx \n x\nx", "é# ü*\tñ", "one two three four five " * 2, "A\nA\r\nA\n", "\n\n\n"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: counts(r) for r in rule_counts(frame).collect()} == {k: brute_force(t) for k, t in enumerate(texts)}


def test_corner_rows(spark):
    labels = spark.createDataFrame([(4, 1), (5, 1), (5, 1), (None, 1), (6, None), (99, 0)], "doc_id long, quality int")
    result = judge(documents(spark), labels).collect()
    assert len(result) == 10
    assert {r["doc_id"]: r["kept"] for r in result if r["doc_id"] in (1, 2, 3, 4)} == dict.fromkeys((1, 2, 3, 4), False)
    without = judge(documents(spark), labels.limit(0)).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in without)
    assert judge(empty(spark), labels).count() == 0


def test_a_lone_row_is_isolated_sooner_than_one_among_many():
    random = np.random.default_rng(4)
    rows = random.normal(0, 0.01, (500, 4))
    scores = Forest(rows).scores(np.array([[0, 0, 0, 0], [0.5, 0.5, 0.5, 0.9]]))
    assert scores[1] > scores[0] + 0.1


def test_threshold_parts_the_labels():
    good, bad = np.zeros(100), np.zeros(100)
    good[10:40], bad[60:70] = 5, 3
    assert 0.39 < best_threshold(good, bad) <= 0.6
    assert best_threshold(np.zeros(100), np.zeros(100)) >= 0
