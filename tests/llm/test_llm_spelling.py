import zlib
from collections import Counter
from itertools import combinations

import pytest
from corner import documents, empty
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from storelens.llm import spelling


def edits(word, letters):
    made = {word[:i] + word[i + 1:] for i in range(len(word))}
    made |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in letters}
    made |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return made - {word}


def brute(counts):
    letters = set("".join(counts))
    near = {w: {x for x in edits(w, letters) if x in counts and x} for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out, key=str)


def grouped(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted((tuple(r) for r in spelling.spelling_groups(df).collect()), key=str)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.text("abàé", min_size=1, max_size=7), st.integers(1, 40), min_size=1, max_size=60))
def test_equal_to_brute_force(spark, counts):
    assert grouped(spark, counts) == brute(counts)


def test_every_single_edit_of_long_and_repeating_words_is_found(spark):
    base = ["aaaaaaa", "abcabcabcabc", "réseaux", "mississippi", "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzz"]
    counts = Counter({w: 1000 for w in base})
    for w in base:
        for x in edits(w, "abéz"):
            counts.setdefault(x, 10)
    got = grouped(spark, counts)
    assert got == brute(counts)


def test_a_chain_is_followed_to_its_end(spark):
    counts = {"aaaaa" + "b" * k: 2 ** k for k in range(12)}
    rows = {r[0]: r for r in grouped(spark, counts)}
    assert {r[2] for r in rows.values()} == {"aaaaa" + "b" * 11}
    assert rows["aaaaa"][1] == "aaaaab"


def test_crowds_of_words_with_the_same_letters_meet_in_halves(spark):
    words = ["".join(p) + "".join(q) for p in combinations("abcdefghij", 5) for q in (sorted(set("abcdefghij") - set(p)),)]
    signed = spelling._signatures(spark.createDataFrame([(w, 5) for w in words], "word string, n long"))
    widest = signed.where("kind = 0").groupBy("key").count().agg({"count": "max"}).first()[0]
    assert len(words) == 252 and widest <= 12


def test_vocabulary_is_counted_like_brute_force(spark):
    texts = [(i, f"Reseau réseau RÉSEAU thebig thebig{i % 3} word{i} aÿÀb×c÷d {'tion' * (i % 4)}") for i in range(300)]
    low = str.maketrans(spelling._UPPER, spelling._LOWER)
    import re
    counts, cut = Counter(), 0
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t):
            run = run.translate(low)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 97 == 0:
                at, cut = h % len(run), cut + 1
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    want = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    got = spelling.vocabulary(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r["word"]: r["n"] for r in got} == want and cut > 3 and len(got) == len(want)


def test_corner_rows(spark):
    docs = documents(spark, [(20, "Étang ÉTANG étang étang x" * 3)])
    rows = {r["word"]: r for r in spelling.spelling_variants(docs, dropped_of=None).collect()}
    assert rows["these"]["n"] == 3 and rows["these"]["form"] is None and rows["these"]["root"] == "these"
    assert all(r["n"] >= 3 and len(w) >= 5 for w, r in rows.items())
    assert spelling.spelling_variants(empty(spark)).count() == 0
    held = spark.createDataFrame([(None, 3), ("", 9), ("worda", None), ("word", 5), ("a", 50), ("b", 7)], "word string, n long")
    got = {r["word"]: tuple(r) for r in spelling.spelling_groups(held).collect()}
    assert got == {"": ("", None, "", 9, 0, None), "word": ("word", None, "word", 5, 0, None), "a": ("a", None, "a", 50, 1, None), "b": ("b", "a", "a", 7, 1, 50)}
    with pytest.raises(ValueError):
        spelling.spelling_groups(held, ratio=1)
