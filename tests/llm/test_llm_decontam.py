import hashlib
import random
import re

import pytest
from corner import documents, empty

from storelens.llm.decontam import contamination, decontaminate

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute_force(docs, items):
    windows = {}
    for i, text in items:
        w = words(text)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    rows = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        listed = ",".join(sorted(str(f) for f in found if f is not None))
        rows.append((i, len(w), len(hit), len(found - {None}), hashlib.sha256(listed.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return rows


def got(df):
    return [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect()]


@pytest.mark.parametrize("seed", [1, 2])
def test_short_items_repeats_and_edges_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choice("ab cd ef É1 x".split()) for _ in range(n))
    items = [(k, say(n)) for k, n in enumerate([2, 3, 5, 12, 13, 14, 30, 40, 0])] + [(6, "ab ab ab"), (None, say(13)), (20, None), (21, "... --")]
    docs = [(100 + k, say(rng.randrange(0, 60))) for k in range(60)]
    docs += [(300, f"xx, {items[6][1].upper()}!"), (301, "ab " * 200), (302, items[4][1]), (303, items[7][1] + "-" + items[3][1])]
    frame = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(got(frame)) == sorted(brute_force(docs, items))


def test_corner_rows(spark):
    items = spark.createDataFrame([(1, "the same words in these two rows here", "x"), (1, "the same words in these two rows here", "y")], "item_id long, text string, key string")
    result = got(contamination(documents(spark), items))
    assert len(result) == 10
    by_id = {r[0]: r for r in result if r[0] is not None}
    assert [by_id[i][5] for i in (1, 2, 3, 4, 5, 6, 7)] == [False] * 5 + [True, True]
    assert by_id[6][1:4] == (8, 8, 1)
    kept = decontaminate(documents(spark), items)
    assert kept.columns == documents(spark).columns and kept.count() == 7
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(documents(spark), none).count() == 10
    assert contamination(empty(spark), items).count() == 0
