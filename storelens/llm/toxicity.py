"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded text.

Texts are lower-cased; letters of other scripts that look like Latin ones, and digits and signs that
stand for letters, are folded to the letter meant; punctuation becomes a blank. Lexicon terms are word
beginnings with a weight. A text's score is the logistic of its summed weights per hundred words;
phrases of the exception list take back the weight of the terms inside them.

The lexicon and the logistic are learned from labels on a bounded sample of labelled rows
(``MOST_ROWS`` of each label, by hash of the id); scoring reads every row and whole texts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.shared import column, hashed_sample, only, write_once

# Bound of the sample that the model is fitted on, for each label.
MOST_ROWS = 4000
# The lengths of word beginnings that may become terms.
LENGTHS = range(3, 9)
# What a term must show: the logarithm of its odds ratio, and twice the logarithm of its likelihood ratio.
LEAST_WEIGHT, LEAST_EVIDENCE = 2.0, 16.0
# A task hands on what it found when it holds so many terms in context.
HELD = 200_000

# Letters of other scripts by the Latin letter they look like, and signs by the letter they stand for.
HOMOGLYPHS = {
    "а": "a", "α": "a", "в": "b", "с": "c", "ϲ": "c", "ԁ": "d", "е": "e", "ε": "e", "ё": "e", "һ": "h", "н": "h",
    "і": "i", "ι": "i", "ı": "i", "ј": "j", "к": "k", "κ": "k", "ӏ": "l", "м": "m", "ո": "n", "η": "n", "о": "o",
    "ο": "o", "ο": "o", "р": "p", "ρ": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "τ": "t", "υ": "u", "ս": "u",
    "ѵ": "v", "ν": "v", "ԝ": "w", "ω": "w", "х": "x", "χ": "x", "у": "y", "γ": "y", "ʐ": "z",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
# Phrases in which a word of abuse means something else.
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "sore loser", "idiot proof", "pathetic fallacy", "scum line")

_FULL_WIDTH = {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}
_INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
_QUOTES = dict.fromkeys([0xA1, 0xAB, 0xBB, 0xBF, *range(0x2010, 0x2060)], " ")
_LOOKALIKES = str.maketrans(HOMOGLYPHS) | _FULL_WIDTH | _QUOTES | _INVISIBLE
_ASCII = bytes(
    ord(SIGNS[chr(b)]) if chr(b) in SIGNS else b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)
)
# Anything but ASCII and the Latin letters with accents may be a lookalike or invisible.
_SUSPECT = re.compile("[¡«­»¿ıʐͰ-֏​-⁯︀-￯]")


def fold(text: str) -> str:
    """Lower case, lookalikes and stand-in signs as letters, punctuation as blanks, a blank at both ends."""
    text = text.lower()
    if not text.isascii() and _SUSPECT.search(text):
        text = text.translate(_LOOKALIKES)
    return " " + text.encode("utf-8", "surrogatepass").translate(_ASCII).decode("utf-8", "surrogatepass") + " "


@dataclass
class Lexicon:
    """Terms are word beginnings with a leading blank, in folded form, by weight."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    bias: float = -4.0
    slope: float = 1.0

    def automaton(self) -> ahocorasick.Automaton | None:
        machine = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            machine.add_word(term, weight)
        for phrase in self.exceptions:
            inside = sum(w for term, w in self.terms.items() if term in fold(phrase))
            if inside and fold(phrase) not in self.terms:
                machine.add_word(fold(phrase), -inside)
        if not len(machine):
            return None
        machine.make_automaton()
        return machine

    def strengths(self, texts: Iterable[str | None]) -> np.ndarray:
        """Per text the logarithm of one plus the weight per hundred words."""
        machine = self.automaton()
        found = []
        for text in texts:
            folded = fold(text) if isinstance(text, str) else " "
            total = sum(w for _, w in machine.iter(folded)) if machine else 0.0
            words = folded.count(" ") if total > 0 else 1
            if total > 0:
                words = max(1, len(folded.split()))
            found.append(math.log1p(100.0 * max(total, 0.0) / words))
        return np.array(found, dtype=float)

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(self.bias + self.slope * self.strengths(texts))))


def held_out_rows(id_column: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text is a multiple of five."""
    return F.crc32(id_column.cast("string")) % 5 == 0


def learnable(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of the labels that are not held out; of several for one id, the larger."""
    rows = only(labels, ["doc_id", "toxic"]).where("doc_id is not null and toxic is not null")
    return rows.where(~held_out_rows(F.col("doc_id"))).groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))


def labelled_sample(docs: DataFrame, rows: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """``toxic, text`` of at most ``most_rows`` labelled rows of each label."""
    chosen = [hashed_sample(rows.where(F.col("toxic") == y), ["doc_id"], most_rows) for y in (0, 1)]
    # The sample's bound, twice MOST_ROWS ids, is what allows the broadcast: no text is shuffled.
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))
    return only(docs, ["doc_id", "text"]).join(sample, "doc_id").select("toxic", F.coalesce("text", F.lit("")).alias("text"))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``term, toxic, context``: every word beginning with the word before it, hashed; once for many texts."""
    found: set[tuple[str, int, int]] = set()

    def made():
        rows = list(found)
        found.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([r[2] for r in rows], pa.int64())], names=["term", "toxic", "context"],
        )

    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            label, words = int(toxic == 1), fold(text).split()
            for before, word in set(zip(["", *words], words)):
                context = zlib.crc32(before.encode("utf-8", "surrogatepass"))
                found.update([(" " + word[:k], label, context) for k in LENGTHS if len(word) >= k])
                if len(found) > HELD:
                    yield made()
    yield made()


def surprise(a: Column, n: int, b: Column, m: int) -> Column:
    """Twice the logarithm of the likelihood ratio of ``a`` of ``n`` against ``b`` of ``m`` occurrences; 0 where nothing can be told."""
    def part(k, total, rate):
        # Nothing times the logarithm of nothing is nothing.
        return F.when(k > 0, k * F.log(rate)).otherwise(0.0) + F.when(total > k, (total - k) * F.log(1 - rate)).otherwise(0.0)

    if not n or not m:
        return F.lit(0.0)
    a, b = F.least(a, F.lit(n)).cast("double"), F.least(b, F.lit(m)).cast("double")
    both = (a + b) / float(n + m)
    return F.when(a + b > 0, 2 * (part(a, F.lit(n), a / n) + part(b, F.lit(m), b / m) - part(a, F.lit(n), both) - part(b, F.lit(m), both))).otherwise(0.0)


def best_cut(x: np.ndarray, y: np.ndarray, clean_weight: float) -> float:
    """The place between two values that misjudges least; of equal ones the widest gap's middle."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    missed = np.concatenate([[0.0], np.cumsum(y == 1)])
    false = clean_weight * np.concatenate([np.cumsum((y == 0)[::-1])[::-1], [0.0]])
    places = np.flatnonzero(np.diff(x) > 0)
    if not len(places):
        return float(x.max()) + 1.0
    errors = missed[places + 1] + false[places + 1]
    best = places[errors <= errors.min() + 1e-9]
    widest = best[np.argmax(x[best + 1] - x[best])]
    return float((x[widest] + x[widest + 1]) / 2)


def _slope(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic bias and slope by Newton steps; both labels weigh alike, a small ridge keeps them finite."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    design, beta = np.stack([np.ones_like(x), x], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        slope = design.T @ (weight * (p - y)) + 1e-4 * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-4 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Learn the lexicon and the logistic from rows that are not held out.

    Each word beginning of the sample counts once after each different word, since a word that many
    copies of one text repeat has one context only. Every beginning whose counts show enough weight
    and evidence for the label becomes a term, however many there are; of beginnings that extend each
    other the best one stays. No labels, or labels of one kind only, give an empty lexicon, which
    scores every text below a half.
    """
    rows = learnable(labels)
    sample = write_once(labelled_sample(docs, rows, most_rows), "toxicity-sample")
    count = lambda df: {r["toxic"]: r["n"] for r in df.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    totals, labelled = count(sample), count(rows)
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    lexicon = Lexicon(exceptions=exceptions)
    if not pos or not neg:
        return lexicon
    words = {r["toxic"]: r["n"] for r in sample.groupBy("toxic")
             .agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).collect()}
    seen = sample.mapInArrow(_contexts, "term string, toxic int, context long").distinct()
    spread = seen.groupBy("term").agg(F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b"))
    weight = F.log((F.col("a") + 0.5) / words[1]) - F.log((F.col("b") + 0.5) / words[0])
    shown = spread.select("term", weight.alias("weight"), surprise(F.col("a"), words[1], F.col("b"), words[0]).alias("evidence"))
    # The sample's bound is the bound of what is collected here.
    shown = shown.where((F.col("weight") > LEAST_WEIGHT) & (F.col("evidence") > LEAST_EVIDENCE)).collect()
    # Of terms of nearly the same evidence, the longer one is the more exact.
    ranked = [(round(20 * math.log(r["evidence"])), len(r["term"]), r["term"], r["weight"]) for r in shown]
    longer: set[str] = set()
    for _, _, term, weight in sorted(ranked, reverse=True):
        begins = [term[:k] for k in range(1, len(term) + 1)]
        if term not in longer and not any(t in lexicon.terms for t in begins):
            lexicon.terms[term] = round(weight, 4)
            longer.update(begins)
    if not lexicon.terms:
        return lexicon
    known = sample.select("toxic", strength_column(lexicon, F.col("text")).alias("x")).toPandas()
    x, y = known["x"].to_numpy(float), known["toxic"].to_numpy(int)
    # The slope is the logistic's, the half is where the labels part with the fewest errors.
    lexicon.slope = max(_slope(x, y)[1], 0.1)
    share = (labelled[0] / neg) / (labelled[1] / pos)
    lexicon.bias = -lexicon.slope * best_cut(x, y, share)
    return lexicon


def strength_column(lexicon: Lexicon, text: Column) -> Column:
    @F.arrow_udf("double")
    def strength(texts: pa.Array) -> pa.Array:
        return pa.array(lexicon.strengths(texts.to_pylist()), pa.float64())

    return strength(text)


def score_column(lexicon: Lexicon, text: Column) -> Column:
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(lexicon.scores(texts.to_pylist()), pa.float64())

    return score(text)


def toxicity(docs: DataFrame, lexicon: Lexicon, text_column: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from a half on), row by row, without a shuffle.

    Null and empty texts score as texts without a match. Repeated rows score alike. Columns named
    ``score`` or ``predicted`` that ``docs`` already has are replaced.
    """
    return docs.withColumn("score", score_column(lexicon, column(text_column))).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
