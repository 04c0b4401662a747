"""Language identification by hierarchical discrimination.

A text's letters, in lower case and with one blank between words, give counts of runs of one to three
characters, hashed into ``BUCKETS``; their square roots, scaled to length one, are its features. Linear
support vector machines, one for each two families, choose the family of languages; machines for each
two languages of that family then tell the closely related ones apart. Most contests won decide, ties
by the sum of margins, then by name. A language outside ``FAMILIES`` is a family of its own.

The machines are fitted by Spark ML on at most ``MOST_ROWS`` texts of each language, those with the
smallest hashes of their ids; prediction reads every row and whole texts, in pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.llm.shared import column, only, write_once
from storelens.llm.words import U64, constants, mix

# Bound of the sample that the machines are fitted on, for each language.
MOST_ROWS = 1500
# Hash buckets of the features, longest run of characters, characters of a text looked at in one piece.
BUCKETS, LONGEST, PIECE = 1 << 13, 3, 1 << 20
# What is predicted for a text without letters.
UNDETERMINED = "und"
# Steepness of the logistic that turns a margin into a score.
STEEPNESS = 3.0

# Language codes by family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "semitic": ("am", "ar", "he", "mt"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "malayic": ("id", "jv", "ms", "su", "tl"),
}
FAMILY_OF = {language: family for family, languages in FAMILIES.items() for language in languages}
_FACTORS = constants(LONGEST + 1, 909)


@lru_cache(maxsize=1)
def _folding() -> np.ndarray:
    """Each code point's lower-case letter, or 0 where it is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            lower = letter.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text; both empty where it has no letter."""
    folding, counts, before = _folding(), None, np.array([32], np.uint32)
    for start in range(0, len(text), PIECE):
        letters = folding[np.frombuffer(text[start:start + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)]
        # Letters stay, and of each stretch of other characters the first, as a blank.
        known = letters > 0
        after = np.empty_like(known)
        after[:1], after[1:] = before[-1] != 32, known[:-1]
        said = np.where(known, letters, np.uint32(32))[known | after]
        if not len(said):
            continue
        joined = np.concatenate([before, said])
        codes, done = joined.astype(U64), len(before)
        for n in range(1, LONGEST + 1):
            # Runs that end in this piece.
            ends = np.arange(max(done, n - 1), len(codes))
            total = np.full(len(ends), U64(n)) * _FACTORS[0]
            for k in range(n):
                total = (total + codes[ends - k]) * _FACTORS[k + 1]
            if n == 1:
                total = total[joined[ends] != 32]
            found = np.bincount((mix(total) >> U64(51)).astype(np.int64), minlength=BUCKETS)
            counts = found if counts is None else counts + found
        before = joined[-(LONGEST - 1):]
    buckets = np.flatnonzero(counts) if counts is not None else np.empty(0, np.int64)
    if not len(buckets):
        return buckets, np.empty(0)
    values = np.sqrt(counts[buckets])
    return buckets, values / np.sqrt((values * values).sum())


@dataclass
class Contests:
    """One machine for each two of ``names``; a positive margin speaks for the first."""

    names: list[str]
    weights: dict[tuple[str, str], tuple[np.ndarray, float]] = field(default_factory=dict)

    def winner(self, buckets: np.ndarray, values: np.ndarray) -> tuple[str, float]:
        """The name that wins, and the logistic of its smallest margin (1 where there is no other)."""
        margins: dict[str, list[float]] = {n: [] for n in self.names}
        for (a, b), (weights, shift) in self.weights.items():
            margin = float(weights[buckets] @ values + shift)
            margins[a].append(margin)
            margins[b].append(-margin)
        best = min(self.names, key=lambda n: (-sum(m > 0 for m in margins[n]), -sum(margins[n]), n))
        least = min(margins[best], default=np.inf)
        return best, float(1 / (1 + np.exp(-STEEPNESS * least)))


@dataclass
class LanguageModel:
    """The contest of families, and the contest of languages inside each."""

    families: Contests
    languages: dict[str, Contests]

    def predict(self, text: str | None) -> tuple[str, float]:
        buckets, values = features(text or "")
        if not len(buckets) or not self.families.names:
            return UNDETERMINED, 0.0
        family, sure = self.families.winner(buckets, values)
        language, within = self.languages[family].winner(buckets, values)
        return language, sure * within


def held_out_rows(doc_id: Column) -> Column:
    """Rows that nothing is learned from: the remainder of their id's checksum by 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sample(docs: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of each language. Rows far beyond the bound are passed over where they are
    read, by each language's count, so what is shuffled to one language's window is about the bound itself."""
    # One count for each language, that is for each class to tell apart.
    counts = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return docs.select("lang", "text")
    place = F.xxhash64("doc_id", F.lit(77))
    shares = [F.lit(x) for lang, n in counts.items() for x in (lang, int(min(1.0, (1.5 * most + 1000) / n) * (1 << 30)))]
    near = docs.where(F.pmod(F.xxhash64(place), F.lit(1 << 30)) < F.create_map(*shares)[F.col("lang")])
    order = Window.partitionBy("lang").orderBy(place, "text")
    return near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).select("lang", "text")


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [features(t or "") for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([b.tolist() for b, _ in made], pa.list_(pa.int32())), pa.array([v.tolist() for _, v in made], pa.list_(pa.float64()))],
            names=["lang", "buckets", "values"],
        )


def _contests(rows: DataFrame, name: str, names: list[str], rounds: int, penalty: float) -> Contests:
    from pyspark.ml.classification import LinearSVC

    made = Contests(names)
    for a, b in combinations(names, 2):
        pair = rows.where(F.col(name).isin(a, b)).select((F.col(name) == a).cast("double").alias("label"), "features")
        fitted = LinearSVC(maxIter=rounds, regParam=penalty, standardization=False).fit(pair)
        made.weights[a, b] = (fitted.coefficients.toArray(), float(fitted.intercept))
    return made


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
        most: int = MOST_ROWS, rounds: int = 25, penalty: float = 1e-4) -> LanguageModel:
    """Machines learned from the rows with a text with letters, a language and an id that is not held out.

    A table without such rows gives a model that predicts ``und``; one with a single language predicts it
    for every text with letters.
    """
    from pyspark.ml.linalg import Vectors, VectorUDT

    known = only(docs, [id_column, text_column, lang_column]).toDF("doc_id", "text", "lang")
    known = known.where("doc_id is not null and text is not null and lang is not null").where(~held_out_rows(F.col("doc_id")))
    sampled = _sample(known, most).mapInArrow(_featured, "lang string, buckets array<int>, values array<double>").where("size(buckets) > 0")
    held = write_once(sampled, "language-features")
    # As many names as classes; the features themselves stay on the executors.
    languages = sorted(r["lang"] for r in held.select("lang").distinct().collect())
    family_of = {x: FAMILY_OF.get(x, x) for x in languages}
    vector = F.udf(lambda b, v: Vectors.sparse(BUCKETS, b, v), VectorUDT())
    rows = held.select("lang", vector("buckets", "values").alias("features"))
    if languages:
        rows = rows.withColumn("family", F.create_map(*[F.lit(x) for pair in family_of.items() for x in pair])[F.col("lang")])
    families = sorted(set(family_of.values()))
    within = {f: [x for x in languages if family_of[x] == f] for f in families}
    return LanguageModel(
        _contests(rows, "family", families, rounds, penalty),
        {f: _contests(rows, "lang", names, rounds, penalty) for f, names in within.items()},
    )


def identify(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    A null text, an empty one and one without a letter give ``und`` with score 0. A row without an id is
    predicted like any other. Equal texts get equal results; further columns are ignored, an empty table
    gives an empty result. Memory follows the batch and, beyond ``PIECE`` characters, not the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shared.value.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = only(docs, [id_column, text_column]).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    found = rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out_rows(column("doc_id")).alias("held_out"), "lang_pred", "score")
