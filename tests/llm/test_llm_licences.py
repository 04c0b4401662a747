import math

import pytest

from conftest import DATA
from pyspark.sql import functions as F
from storelens.llm.licenses import TEMPLATES, THRESHOLD, own_licences, scan, terms_in, weigh
from storelens.llm.queries import op1_licences


def brute_force(files):
    """The best line of each file by the cosine of full vectors, with every line compared."""
    texts = [(p, t) for p, t in files if t is not None]
    known = {t for said in TEMPLATES.values() for x in said for t in terms_in(x)}
    df = {t: sum(t in set(terms_in(x)) for _, x in texts) for t in known}
    unseen = math.log(len(texts) + 1) + 1
    idf = {t: math.log((len(texts) + 1) / (n + 1)) + 1 for t, n in df.items()}

    def vector(text):
        found = terms_in(text)
        return {t: found.count(t) * idf.get(t, unseen) for t in found}

    def norm(v):
        return math.sqrt(sum(w * w for w in v.values()))

    templates = [(name, vector(x)) for name, said in TEMPLATES.items() for x in said]
    best = {}
    for path, text in texts:
        for n, line in enumerate(text.split("\n")):
            v = vector(line)
            for name, t in templates:
                cosine = round(sum(w * t.get(k, 0.0) for k, w in v.items()) / norm(v) / norm(t), 9) if v else 0.0
                if cosine >= THRESHOLD:
                    best[path] = max(best.get(path, (0, 0, "")), (cosine, -n, name))
    return {p: (-b[1], b[2], b[0]) for p, b in best.items()}


def test_lines_equal_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").selectExpr("cast(doc_id as string) as path", "text")
    files = [(r["path"], r["text"]) for r in docs.collect()]
    want = brute_force(files)
    got = {r["path"]: (r["line"], r["licence"], r["similarity"]) for r in own_licences(docs).collect()}
    assert got.keys() == want.keys() and len(want) > 20
    for path, (line, licence, similarity) in want.items():
        assert got[path][:2] == (line, licence) and got[path][2] == pytest.approx(similarity, abs=1e-8)


MIT, GPL, APACHE = (TEMPLATES[k][0] for k in ("MIT", "GPL-3.0", "Apache-2.0"))


def test_the_nearest_ancestor_counts(spark):
    rows = [
        ("LICENSE", MIT), ("a/LICENSE", f"Copyright\n\n{GPL}"), ("a/b/c/x.py", "code"), ("a/b/c/own.py", f"code\n# {APACHE}\ncode"), ("a/b/c/d/LICENSE", "nothing here"),
        ("z/y.py", ""), ("ab/y.py", None), ("top.py", "code"), ("a/b/c/d/e.py", "code"),
    ]
    found = {r["path"]: (r["own"], r["inherited_from"], r["licence"]) for r in scan(spark.createDataFrame(rows, "path string, text string"), F.col("path").rlike("(^|/)LICENSE$")).collect()}
    assert found["a/b/c/x.py"] == (None, "a", "GPL-3.0") and found["a/b/c/d/e.py"] == (None, "a", "GPL-3.0")
    assert found["a/b/c/own.py"] == ("Apache-2.0", None, "Apache-2.0")
    assert found["z/y.py"] == found["ab/y.py"] == found["top.py"] == (None, "", "MIT")


def test_corner_rows(spark):
    long = "word of the and in " * 50_000 + f"\n{MIT}"
    rows = [(None, MIT, "x"), ("a/1", None, "x"), ("a/2", long, "x"), ("a/2", long, "x"), ("a/3", f"{MIT}\n{MIT}", "x"), ("b/L1", MIT, "x"), ("b/L2", GPL, "x"), ("b/4", "", "x")]
    files = spark.createDataFrame(rows, "path string, text string, licence string")
    found = {r["path"]: r for r in scan(files, F.col("path").contains("/L")).collect()}
    assert sorted(found) == ["a/1", "a/2", "a/3", "b/4", "b/L1", "b/L2"]
    assert found["a/2"]["own"] == "MIT" and found["a/2"]["line"] == 1 and found["a/3"]["line"] == 0
    assert found["a/1"]["licence"] is None and found["b/4"]["licence"] == "MIT"
    none = spark.createDataFrame([], files.schema)
    assert scan(none, F.lit(True)).count() == 0


def test_anchors_miss_nothing():
    _, _, vectors, anchors = weigh({"license": 3, "the": 900, "of": 800}, 1000)
    for _, _, vector in vectors:
        assert math.sqrt(sum(w * w for t, w in vector.items() if t not in anchors)) < THRESHOLD


def test_the_query_covers_all_documents(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.1/documents.parquet")
    rows = op1_licences(spark, f"{DATA}/sf0.1").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    assert any(r["inherited_from"] for r in rows)
