"""Quality rules: rule statistics of every text, and an isolation forest over them.

The forest grows on the statistics of labelled good rows: each tree cuts a random statistic at a
random place until few rows are left, so an odd text comes to stand alone after few cuts. The score is
the usual ``2 ** (-path / expected path)``. The threshold comes from the scores of all labelled rows:
of the cuts that lose at most ``LOSS`` of the good ones, the one that tells the labels apart best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.shared import hashed_sample, only, write_once
from storelens.llm.words import NOT_BLANK, U64, Words, byte_set, gram_hashes, mix, slices, span_hashes, text_bytes

GRAM = 5
# Base rules: fewer words than this, or a larger share of words (percent) in repeated windows, fail.
LEAST_WORDS, MOST_REPEATED = 10, 20
# Bound of the labelled sample that the forest grows on, its trees, and the rows of each tree.
MOST_ROWS, TREES, ROWS = 8192, 128, 256
# Share of good labelled rows that the threshold may lose.
LOSS = 0.005
# Bins of the scores when the threshold is chosen.
BINS = 2000
SEED = 20

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_same_words", "n_upper", "n_letters"]
# Statistics that the forest sees, with the least width of the range it cuts in.
# Digits, word length and repeated lines are left out: short good texts differ in them as much as bad ones.
STATISTICS = {"symbols": 0.1, "repeated": 0.2, "same_words": 0.1, "upper": 0.5}

_SYMBOLS = byte_set(lambda b: chr(b) in "#*$%&|<>")
_UPPER = byte_set(lambda b: 0x41 <= b <= 0x5A)
_LETTERS = byte_set(lambda b: chr(b).isalpha() and b < 128)
_FIRST_BYTES = byte_set(lambda b: b & 0xC0 != 0x80)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeats(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether each hash occurs twice or more for its owner."""
    if not len(hashes):
        return np.empty(0, bool)
    _, inverse, counts = np.unique(hashes ^ mix(owner.astype(U64)), return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def text_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The ``COUNTS`` of each text, one row per text."""
    w = Words(data, offsets, NOT_BLANK, lower=False)
    n, first = len(offsets) - 1, w.first
    n_words = np.diff(first)
    hashes = w.hashes()
    owner = np.repeat(np.arange(n), n_words)
    # Windows of five words within one text, those found again, and the words they cover.
    at = np.arange(max(0, len(hashes) - GRAM + 1))
    at = at[owner[at] == owner[at + GRAM - 1]] if len(at) else at
    at = at[_repeats(gram_hashes(hashes, GRAM)[at], owner[at])]
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + GRAM, -1)
    covered = np.cumsum(edge)[:-1] > 0
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    # Lines end at a line feed or with their text; those without a word don't count.
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    worded = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends = starts[worded], ends[worded]
    line_owner = np.searchsorted(offsets, starts, "right") - 1
    n_lines = np.bincount(line_owner, minlength=n)
    lines = np.unique(np.stack([line_owner.astype(U64), span_hashes(data, starts, ends)]), axis=1) if len(starts) else np.empty((2, 0), U64)
    distinct = np.bincount(lines[0].astype(np.int64), minlength=n)
    return np.stack([
        n_words, _per_text(w.inside & _FIRST_BYTES[data], offsets), _per_text(_SYMBOLS[data], offsets), n_lines - distinct,
        _per_text(covered, first), _per_text(same, first), _per_text(_UPPER[data], offsets), _per_text(_LETTERS[data], offsets),
    ], axis=1)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        parts = [np.empty((0, len(COUNTS)), np.int64)]
        for lo, hi in slices(offsets):
            at = offsets[lo:hi + 1]
            parts.append(text_counts(data[at[0]:at[-1]], at - at[0]))
        table = np.concatenate(parts)
        yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(table[:, k]) for k in range(len(COUNTS))], names=["doc_id", *COUNTS])


def rule_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and the counts of each text; null and empty texts have zeros."""
    texts = only(docs, [id_column, text_column]).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return texts.mapInArrow(_counts, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def statistics(counts: pd.DataFrame) -> np.ndarray:
    words = np.maximum(counts["n_words"].to_numpy(float), 1)
    letters = np.maximum(counts["n_letters"].to_numpy(float), 1)
    return np.stack(
        [counts["n_symbols"] / words, counts["n_repeat_words"] / words, counts["n_same_words"] / words, counts["n_upper"] / letters], axis=1
    )


def expected_path(n) -> np.ndarray:
    """The mean path of an unsuccessful search in a random tree of ``n`` rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class Forest:
    """Trees as flat arrays: cut statistic, cut place, children, and the path length at a leaf."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, size: int = ROWS, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.size = min(size, len(rows))
        self.widths = np.array(list(STATISTICS.values()))
        self.trees = []
        for _ in range(trees):
            chosen = rows[random.choice(len(rows), self.size, replace=False)]
            self.trees.append(self._tree(chosen, int(np.ceil(np.log2(max(self.size, 2)))), random))

    def _tree(self, rows, limit, random):
        nodes: list[list[float]] = []

        def grow(part: np.ndarray, depth: int) -> int:
            me = len(nodes)
            nodes.append([-1, 0.0, 0, 0, depth + float(expected_path(len(part)))])
            if depth < limit and len(part) > 1:
                low, high = part.min(axis=0), part.max(axis=0)
                # Each range is widened, so a statistic that is constant among good rows still tells odd ones.
                pad = self.widths * random.random(len(low))
                k = int(random.integers(len(low)))
                cut = float(random.uniform(low[k] - pad[k], high[k] + pad[k]))
                left = part[:, k] < cut
                nodes[me][:2] = [k, cut]
                nodes[me][2] = grow(part[left], depth + 1)
                nodes[me][3] = grow(part[~left], depth + 1)
            return me

        grow(rows, 0)
        table = np.array(nodes)
        return table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3].astype(np.int64), table[:, 4]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not len(rows):
            return np.empty(0)
        total = np.zeros(len(rows))
        for which, cut, left, right, path in self.trees:
            at = np.zeros(len(rows), np.int64)
            live = np.flatnonzero(which[at] >= 0)
            while len(live):
                node = at[live]
                at[live] = np.where(rows[live, which[node]] < cut[node], left[node], right[node])
                live = live[which[at[live]] >= 0]
            total += path[at]
        return 2.0 ** (-total / len(self.trees) / max(float(expected_path(self.size)), 1e-9))


def _scored(counts: DataFrame, forest: Forest) -> DataFrame:
    @F.pandas_udf("double")
    def score(columns: pd.DataFrame) -> pd.Series:
        return pd.Series(forest.scores(statistics(columns)))

    return counts.withColumn("anomaly", score(F.struct(*COUNTS)))


def best_threshold(good: np.ndarray, bad: np.ndarray, loss: float = LOSS) -> float:
    """The score bin from which on a row is odd, out of histograms of both labels over 0 to 1.

    With no bad rows at all, the lowest bin that loses no more than ``loss`` of the good ones.
    """
    lost = good[::-1].cumsum()[::-1] / max(good.sum(), 1)
    caught = bad[::-1].cumsum()[::-1] / max(bad.sum(), 1)
    allowed = lost <= loss
    gain = np.where(allowed, caught - lost, -1.0)
    if not bad.sum():
        return float(np.flatnonzero(allowed)[0] / len(good)) if allowed.any() else 1.0
    # The middle of the bins that do equally well.
    ties = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float((ties[0] + ties[-1]) / 2 / len(good)) if gain.max() > 0 else 1.0


def judge(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``anomaly`` (0 to 1) and ``kept`` for every row of ``docs``.

    The forest grows on at most ``most_rows`` labelled good rows that pass the base rules, by hash of
    the id; the threshold reads all labelled rows that pass them. Without labelled good rows there is
    no verdict: every text that passes the base rules is kept. Null and empty texts fail them. Rows of
    one id get a row each, equal texts equal results. Other columns are ignored.
    """
    spark = docs.sparkSession
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    counted = write_once(rule_counts(docs, id_column, text_column).withColumn("base_failed", base), "quality-counts")
    known = only(labels, ["doc_id", "quality"]).where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = write_once(counted.where("not base_failed").join(known, "doc_id").select("doc_id", "quality", *COUNTS), "quality-labelled")
    sample = hashed_sample(labelled.where("quality = 1"), ["doc_id"], most_rows).select(*COUNTS).toPandas()
    if sample.empty:
        return counted.withColumn("anomaly", F.lit(None).cast("double")).withColumn("kept", ~F.col("base_failed"))
    forest = Forest(statistics(sample))
    bins = (
        _scored(labelled, forest).groupBy((F.col("quality") == 1).alias("good"), F.least(F.floor(F.col("anomaly") * BINS), F.lit(BINS - 1)).alias("bin"))
        .agg(F.count("*").alias("n")).collect()
    )
    histogram = np.zeros((2, BINS))
    for row in bins:
        histogram[int(row["good"]), row["bin"]] = row["n"]
    threshold = best_threshold(histogram[1], histogram[0])
    return _scored(counted, forest).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < threshold))
