"""Benchmark decontamination by winnowing.

Words are lower-cased runs of ASCII letters and digits and non-ASCII characters. A window is thirteen
consecutive words of a benchmark item (a shorter item is one window). Of every seven consecutive
7-grams the one with the smallest hash is kept as a fingerprint, so each passage of thirteen words has
the same fingerprint wherever it stands: no shared passage of that length is missed. Fingerprints of
documents join those of the items; every hit is extended to the windows around it, and these join the
items' windows. Shorter items are looked up by their own length.

The fingerprints of documents are sifted before the shuffle by a Bloom filter of the items'
fingerprints, whose size is fixed beforehand; the joins that follow are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.bloom import bloom, in_bloom
from storelens.llm.shared import apart, column, only, tidy, write_once
from storelens.llm.words import ALNUM, Words, gram_hashes, ranges, slices, text_bytes

WINDOW = 13
GRAM = 7
# So many 7-grams begin within a window: the span over which winnowing keeps the smallest.
SPAN = WINDOW - GRAM + 1


def winnow(grams: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Positions of the fingerprints: per window start from ``first`` to ``last`` (per text, exclusive)
    the rightmost smallest of the ``SPAN`` grams from there on."""
    if len(grams) < SPAN or not (last > first).any():
        return np.empty(0, np.int64)
    n = len(grams) - SPAN + 1
    smallest = grams[:n].copy()
    for k in range(1, SPAN):
        np.minimum(smallest, grams[k:n + k], out=smallest)
    at = np.arange(n)
    place = at.copy()
    for k in range(1, SPAN):
        same = grams[k:n + k] == smallest
        place[same] = at[same] + k
    valid = np.zeros(n + 1, np.int64)
    some = last > first
    np.add.at(valid, first[some], 1)
    np.add.at(valid, last[some], -1)
    return np.unique(place[np.cumsum(valid)[:-1] > 0])


class _Grams:
    """Window hashes and fingerprints of the texts of one slice."""

    def __init__(self, words: Words):
        self.first = words.first
        self.hashes = words.hashes()
        self.counts = np.diff(self.first)
        self.grams = gram_hashes(self.hashes, GRAM)
        self.windows = gram_hashes(self.hashes, WINDOW)
        self.last = np.maximum(self.first[1:] - WINDOW + 1, self.first[:-1])
        self.prints = winnow(self.grams, self.first[:-1], self.last)

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, positions, "right") - 1


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``item_id, kind, n, hash``: windows (kind 0) and fingerprints (kind 1) of each item."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        ids = batch.column(0)
        for lo, hi in slices(offsets):
            at = offsets[lo:hi + 1]
            g = _Grams(Words(data[at[0]:at[-1]], at - at[0], ALNUM, lower=True))
            rows, kinds, sizes, hashes = [], [], [], []
            for i, n in enumerate(g.counts.tolist()):
                a = g.first[i]
                if n >= WINDOW:
                    found = np.unique(g.windows[a:a + n - WINDOW + 1])
                elif n:
                    found = gram_hashes(g.hashes[a:a + n], n)
                else:
                    continue
                rows += [lo + i] * len(found)
                kinds += [0] * len(found)
                sizes += [min(n, WINDOW)] * len(found)
                hashes.append(found)
            owner = g.text_of(g.prints)
            rows += (owner + lo).tolist()
            kinds += [1] * len(owner)
            sizes += [WINDOW] * len(owner)
            hashes.append(g.grams[g.prints])
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows, pa.int64())), pa.array(kinds, pa.int32()), pa.array(sizes, pa.int32()),
                 pa.array(np.concatenate(hashes).view(np.int64))], names=["item_id", "kind", "n", "hash"],
            )


def _candidates(shared, lengths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per row its number of words and the windows around fingerprints that the filter lets through."""
        sieve = shared.value
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for lo, hi in slices(offsets):
                at = offsets[lo:hi + 1]
                g = _Grams(Words(data[at[0]:at[-1]], at - at[0], ALNUM, lower=True))
                prints = g.prints[in_bloom(sieve, g.grams[g.prints])]
                owner = g.text_of(prints)
                # The windows that hold the fingerprint and lie within its text.
                begins = np.maximum(prints - SPAN + 1, g.first[owner])
                sizes = np.minimum(prints + 1, g.last[owner]) - begins
                starts = ranges(begins, sizes)
                found = [(np.repeat(owner, sizes), np.repeat(g.grams[prints], sizes), starts, np.full(len(starts), WINDOW), g.windows[starts])]
                for n in lengths:
                    grams = gram_hashes(g.hashes, n)
                    starts = np.flatnonzero(in_bloom(sieve, grams))
                    text = g.text_of(starts)
                    inside = starts + n <= g.first[text + 1]
                    starts, text = starts[inside], text[inside]
                    found.append((text, grams[starts], starts, np.full(len(starts), n), grams[starts]))
                text, prints, starts, sizes, windows = (np.concatenate(column) for column in zip(*found))
                order = np.argsort(text, kind="stable")
                text = text[order]
                edges = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=hi - lo))]).astype(np.int32)
                hits = pa.StructArray.from_arrays(
                    [pa.array(prints[order].view(np.int64)), pa.array((starts[order] - g.first[text]).astype(np.int32)),
                     pa.array(sizes[order].astype(np.int32)), pa.array(windows[order].view(np.int64))], names=["print", "start", "n", "window"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(g.counts.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(edges), hits)], names=["doc_id", "key", "n_words", "hits"],
                )

    return run


def contamination(docs: DataFrame, items: DataFrame, percent: int = 5, id_column: str = "doc_id",
                  text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """``doc_id, key, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of a window of ``items``, ``n_items`` the items
    with an occurring window; ``items_sha256`` is the digest of their ids, sorted as strings and joined
    by commas. A document is contaminated when at least ``percent`` of a hundred of its words are hit.
    Null and empty texts have no words and no hits; items without words have no window; rows of one
    item id count as one item, items without an id mark words but are not listed. Equal rows get
    equal results: ``key`` is the hash of the text, and with the id it names a row. Other columns are
    ignored. One document's hits meet in one group, which its length bounds.
    """
    spark = docs.sparkSession
    bench = write_once(
        only(items, [item_column, "text"]).toDF("item_id", "text").withColumn("item_id", F.col("item_id").cast("string"))
        .mapInArrow(_item_rows, "item_id string, kind int, n int, hash long"), "benchmark",
    )
    windows = bench.where("kind = 0").select("item_id", "n", F.col("hash").alias("window")).distinct()
    # Items shorter than a window are their own fingerprint.
    prints = bench.where(f"kind = 1 or n < {WINDOW}").select(F.col("hash").alias("print")).distinct()
    lengths = sorted(r["n"] for r in bench.where(f"kind = 0 and n < {WINDOW}").select("n").distinct().collect())
    sieve = spark.sparkContext.broadcast(bloom(prints, "print"))
    texts = only(docs, [id_column, text_column]).toDF("doc_id", "text")
    found = write_once(
        texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text").mapInArrow(
            tidy(_candidates(sieve, lengths)),
            "doc_id long, key long, n_words long, hits array<struct<print: long, start: int, n: int, window: long>>",
        ), "candidates",
    )
    occurring = windows.select("window", "n").distinct()
    hits = (
        found.where("size(hits) > 0").select("doc_id", "key", F.explode("hits").alias("hit")).select("doc_id", "key", "hit.*")
        .join(prints, "print", "left_semi").select("doc_id", "key", "start", "n", "window").distinct()
        .join(occurring, ["window", "n"], "left_semi")
    )
    # Overlapping windows count once: a running end over the windows in order.
    covered = F.expr("""aggregate(sort_array(collect_list(struct(start, n))), struct(0L as upto, 0L as words),
        (acc, w) -> struct(greatest(acc.upto, cast(w.start + w.n as bigint)) as upto,
                           acc.words + greatest(0L, w.start + w.n - greatest(acc.upto, cast(w.start as bigint))) as words)).words""")
    words = hits.groupBy("doc_id", "key").agg(covered.alias("n_hit"))
    pairs = hits.select("doc_id", "key", "window", "n").distinct().join(windows, ["window", "n"]).select("doc_id", "key", "item_id").distinct()
    listed = pairs.groupBy("doc_id", "key").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    per_doc = words.join(listed.withColumnRenamed("doc_id", "d").withColumnRenamed("key", "k"),
                         F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
    per_doc = per_doc.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "n_hit", "items")
    joined = found.select("doc_id", "key", "n_words").join(
        per_doc, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left"
    )
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id", "key", "n_words", n_hit.alias("n_hit"), F.size(items_found).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_found, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (100 * n_hit >= percent * F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    mine, key = apart(docs, "_mine"), apart(docs, "_key")
    bad = contamination(docs, items).where("contaminated").select(F.col("doc_id").alias(mine), F.col("key").alias(key)).distinct()
    same = column("doc_id").cast("long").eqNullSafe(F.col(mine)) & (F.xxhash64(column("text")) == F.col(key))
    return docs.join(bad, same, "left_anti")
