"""Grouping of spelling variants by PartEnum signatures.

A word's letters are a multiset: in unary, a binary vector with one dimension for each letter and
occurrence. One replaced letter changes two of its bits, one inserted or deleted letter one bit, so near
words lie within a Hamming distance of two. PartEnum makes equality of that: dimensions are dealt into
``PARTS`` parts, and a signature is what a word has in all parts but as many as bits may differ, for
every choice of parts. Near words share a signature; an equi-join on signatures finds them:

* words of one length (a replaced letter): two of four parts agree, six choices;
* words whose lengths differ by one (a missing letter): one of two halves agrees, two choices.

The vector forgets the order of letters, so words of the same syllables would meet in crowds. One edit
leaves the front half or the back half of a word as it is; a signature therefore carries one of the
halves as well, once each. Nothing is lost by that, and a bucket is small however common a syllable is.
Pairs of a bucket are verified inside the join, so only near pairs leave it.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.shared import only, write_once

RUN = "[A-Za-zÀ-ÿ]"
PARTS = 4
LEAST_LENGTH, LEAST_COUNT, DROPPED_OF = 5, 3, 97
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_length: int = LEAST_LENGTH,
               least_count: int = LEAST_COUNT, dropped_of: int | None = DROPPED_OF) -> DataFrame:
    """``word, n``: words of at least ``least_length`` code points and ``least_count`` occurrences.

    Words are maximal runs of letters, A-Z lower-cased. Where ``dropped_of`` divides the checksum of
    ``<id>:<run>``, the run loses one letter, at the checksum's remainder by its length; ``None`` drops none.
    """
    texts = only(docs, [id_column, text_column]).toDF("doc_id", "text").where("text is not null")
    # A shorter run can't become a word, so the pattern passes over it.
    runs = F.explode(F.regexp_extract_all("text", F.lit(f"({RUN}{{{least_length},}})"), F.lit(1)))
    said = texts.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), runs.alias("run"))
    said = said.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _UPPER, _LOWER)).otherwise(F.col("run")))
    word = F.col("run")
    if dropped_of:
        hashed = F.crc32(F.concat_ws(":", "doc_id", "run").cast("binary"))
        at = F.pmod(hashed, F.length("run").cast("long")).cast("int")
        cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
        word = F.when(hashed % dropped_of == 0, cut).otherwise(word)
    counted = said.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.col("n") >= least_count) & (F.length("word") >= least_length))


def _signatures(words: DataFrame) -> DataFrame:
    """``key, kind, word, n``: one row for each signature of each word. Kind 0 meets words of its length;
    kind 1 is the longer and kind 2 the shorter word of a pair."""
    letters = F.array_sort(F.split("word", ""))
    # The k-th of equal letters is a dimension of its own.
    dimension = F.transform(F.col("letters"), lambda c, i: F.xxhash64(c, i - F.array_position(F.col("letters"), c)))

    def part(k: int) -> Column:
        own = F.filter(F.col("dimensions"), lambda d: F.pmod(d, F.lit(PARTS)) == k)
        return F.aggregate(own, F.lit(k).cast("long"), lambda a, d: a.bitwiseXOR(d))

    cut = words.where("word <> ''").withColumn("letters", letters).withColumn("dimensions", dimension)
    cut = cut.select("word", "n", F.length("word").alias("size"), F.array(*[part(k) for k in range(PARTS)]).alias("parts"))

    def half(begin: Column, length: Column) -> Column:
        return F.substring(F.col("word"), begin, length)

    def keys(kind: int, size: Column, chosen: list[tuple[int, ...]]) -> list[Column]:
        front = F.floor(size / 2).cast("int")
        back = size - front
        halves = [(0, half(F.lit(1), front)), (1, half(F.col("size") - back + 1, back))]
        same = 0 if kind == 0 else 1
        return [
            F.struct(F.xxhash64(F.lit(same), size, F.lit(which), F.lit(number), said, *[F.col("parts")[p] for p in agreed]).alias("key"), F.lit(kind).alias("kind"))
            for number, agreed in enumerate(chosen) for which, said in halves
        ]

    two_of_four = list(combinations(range(PARTS), PARTS - 2))
    halves = [tuple(range(0, PARTS // 2)), tuple(range(PARTS // 2, PARTS))]
    size = F.col("size")
    made = [*keys(0, size, two_of_four), *keys(1, size - 1, halves), *keys(2, size, halves)]
    return cut.select("word", "n", F.explode(F.array(*made)).alias("s")).select("s.key", "s.kind", "word", "n")


def near_words(words: DataFrame) -> DataFrame:
    """``word, other, n, other_n``: every two words of ``words(word, n)`` that one edit parts, both ways round."""
    signed = write_once(_signatures(words), "signatures")
    one_edit = F.expr("levenshtein(a.word, b.word, 1) = 1")

    def met(left: int, right: int, further: Column) -> DataFrame:
        a, b = signed.where(F.col("kind") == left).alias("a"), signed.where(F.col("kind") == right).alias("b")
        pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & further & one_edit)
        return pairs.select(F.col("a.word").alias("word"), F.col("b.word").alias("other"), F.col("a.n").alias("n"), F.col("b.n").alias("other_n"))

    # Repeats, from signatures that agree in several choices, go before anything is turned round.
    found = met(0, 0, F.col("a.word") < F.col("b.word")).unionByName(met(1, 2, F.lit(True))).distinct()
    both = F.explode(F.array(
        F.struct("word", "other", "n", "other_n"),
        F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("other_n").alias("n"), F.col("n").alias("other_n")),
    ))
    return found.select(both.alias("e")).select("e.*")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` by doubling: each round a word's root becomes its root's. Forms at least double a
    count, so chains, and their logarithm in rounds, are short. Each round is written."""
    reached = write_once(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while True:
        ahead = reached.select(F.col("word").alias("at"), F.col("root").alias("further"))
        joined = reached.join(ahead, reached.root == ahead["at"], "left")
        reached = write_once(
            joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots"
        )
        if reached.where("moved").isEmpty():
            return reached.select("word", "root")


def spelling_groups(words: DataFrame, ratio: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words(word, n)``, whose words are distinct.

    Two words are near if one inserted, deleted or replaced code point parts them. ``form`` is the near
    word of largest ``n``, ties by smallest in code-point order, if that is at least ``ratio`` times the
    word's own; else null. ``root`` is where following forms ends. Rows with a null word or count are
    ignored; the empty word is near nothing; an empty table gives an empty result. With a ratio of one
    or less forms could run in a circle, so it is refused.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    held = write_once(words.select("word", F.col("n").cast("long").alias("n")).where("word is not null and n is not null and n > 0"), "words")
    best = near_words(held).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("order"), "other")).alias("best")
    )
    fits = -F.col("best.order") >= ratio * F.col("n")
    judged = write_once(
        held.join(best, "word", "left").select(
            "word", F.when(fits, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, -F.col("best.order")).alias("form_n")),
        "forms",
    )
    roots = _roots(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", dropped_of: int | None = DROPPED_OF) -> DataFrame:
    """``spelling_groups`` of the words of ``docs``.

    Null and empty texts have no words; a row without an id counts with an empty one; repeated rows count
    as often as they are there; further columns are ignored. Texts are read whole.
    """
    return spelling_groups(vocabulary(docs, id_column, text_column, dropped_of=dropped_of))
