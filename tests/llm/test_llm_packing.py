import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from corner import documents, empty
from tokenizers import Tokenizer

from conftest import DATA
from storelens.llm import packing
from storelens.llm.packing import binary_cuts, cut_windows, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, texts, tokenizer, capacity):
    """Every id of every text lies in one piece, sequences are gapless; returns the padding and the tokens."""
    found = {}
    for r in rows:
        found.setdefault(r["doc_id"], []).append(r)
    for i, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(found[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in group:
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding, sum(r["length"] for r in rows)


def test_round_trip_with_little_padding(spark, tokenizer):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    padding, tokens = check(pack(docs, PATH).collect(), texts, tokenizer, packing.CAPACITY)
    assert padding < 0.01 * tokens


def test_order_is_kept_within_a_partition(spark):
    docs = spark.createDataFrame([(k, "some words of a text. And more!") for k in range(300)], "doc_id long, text string").coalesce(1)
    rows = sorted(pack(docs, PATH, capacity=64).collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)


def test_corner_rows(spark, tokenizer):
    docs = documents(spark, more=[(8, "<|endoftext|> x<|startoftext|>y\x1cz w"), (9, "x" * 30_000)]).coalesce(1)
    rows = pack(docs, PATH, capacity=256).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] not in (None, 6)}
    ours = [r for r in rows if r["doc_id"] in texts]
    check(rows, {}, tokenizer, 256)
    for i, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        pieces = sorted((r for r in ours if r["doc_id"] == i), key=lambda r: r["start"])
        assert sum(r["length"] for r in pieces) == len(ids)
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in pieces)
    assert pack(empty(spark), PATH).count() == 0


def test_cuts_cost_no_more_than_any_other(monkeypatch):
    monkeypatch.setattr(packing, "LEAST_POWER", 1)
    rng = random.Random(3)
    for _ in range(200):
        gaps = [rng.randrange(1, 9) for _ in range(rng.randrange(1, 9))]
        positions = np.concatenate([[0], np.cumsum(gaps)])
        penalties = np.array([rng.choice([0.0, 0.5, 8.0]) for _ in positions])

        def cost(cuts):
            total, before = 0.0, 0
            for k in cuts:
                size = int(positions[k] - positions[before])
                if size > 16:
                    return float("inf")
                total += (0 if size & (size - 1) == 0 else 16 - size) + penalties[k] + packing.WINDOW_COST
                before = k
            return total

        inner = range(1, len(gaps))
        best = min(cost([*c, len(gaps)]) for n in range(len(gaps)) for c in itertools.combinations(inner, n))
        assert cost(cut_windows(positions, penalties, 16)) == pytest.approx(best)


def test_binary_cuts():
    assert binary_cuts(4096) == [4096] and binary_cuts(11) == [8, 2, 1] and binary_cuts(0) == []
