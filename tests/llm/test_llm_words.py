import random
import re

import numpy as np
import pyarrow as pa

from storelens.llm.words import ALNUM, NOT_BLANK, Words, gram_hashes, slices, text_bytes

TEXTS = ["", "a", " A b  c\n", "Ünï cödé—words", None, "x" * 3000, "tab\tone\x0bvt\x0cff\rcr\x1cnot", "a-b_c d.e 12é3", " ", "end "]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abAB é\n\t-._x1Z ") for _ in range(rng.randrange(0, 40))) for _ in range(n)]


def test_words_are_those_of_the_patterns():
    texts = TEXTS + random_texts(300, 1)
    for table, pattern in ((NOT_BLANK, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        data, offsets = text_bytes(pa.array(texts, pa.string()))
        w = Words(data, offsets, table, lower=True)
        low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
        for i, text in enumerate(texts):
            want = re.findall(pattern, (text or "").translate(low))
            got = [w.data[s:e].tobytes().decode() for s, e in zip(w.starts[w.first[i]:w.first[i + 1]], w.ends[w.first[i]:w.first[i + 1]])]
            assert got == want, text


def test_equal_words_and_only_they_have_equal_hashes():
    texts = random_texts(2000, 2)
    data, offsets = text_bytes(pa.array(texts))
    w = Words(data, offsets, NOT_BLANK, lower=False)
    words = [w.data[s:e].tobytes() for s, e in zip(w.starts, w.ends)]
    pairs = set(zip(words, w.hashes().tolist()))
    assert len(pairs) == len(set(words)) == len({h for _, h in pairs})
    grams = gram_hashes(w.hashes(), 3)
    seen = {tuple(words[i:i + 3]): g for i, g in enumerate(grams.tolist())}
    assert len(set(seen.values())) == len(seen)


def test_hashes_do_not_depend_on_the_place():
    a = pa.array(["zebra here", "x zebra"])
    data, offsets = text_bytes(a)
    w = Words(data, offsets, NOT_BLANK, lower=False)
    h = w.hashes()
    assert h[0] == h[3] and h[0] != h[1]
    sliced, at = text_bytes(a.slice(1, 1))
    assert sliced.tobytes() == b"x zebra" and at.tolist() == [0, 7]


def test_slices_cover_all_rows_and_let_a_long_one_stand_alone():
    offsets = np.cumsum([0, 5, 5, 100, 5, 0, 0])
    assert list(slices(offsets, 12)) == [(0, 2), (2, 3), (3, 6)]
