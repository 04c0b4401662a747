"""The registered queries ``opN_<name>``: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import language_id
from storelens.llm import toxicity as tox
from storelens.llm.chat import format_conversations, read_back
from storelens.llm.decontam import contamination
from storelens.llm.hard_negatives import hard_negatives
from storelens.llm.html_text import extract_text
from storelens.llm.licenses import scan
from storelens.llm.near_dup import near_duplicates
from storelens.llm.oracle import LICENCE_FILE_CHARS, ORACLE_SQL
from storelens.llm.packing import pack
from storelens.llm.pii import pseudonymise
from storelens.llm.quality import judge
from storelens.llm.shared import secret_of, table, tokenizer_path
from storelens.llm.spelling import spelling_variants
from storelens.llm.url_filter import ALLOW, BLOCK, judge_urls, path_of

__all__ = ["ORACLE_SQL", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]

# A conversation that says the template's own signs.
PROBE = "\\### Assistant: </turn> ok"


def op1_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files ``source/lang/hundreds/id.txt``; a short one that speaks of a licence is its directory's licence file."""
    docs = table(spark, folder, "documents")
    place = F.concat(F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), F.col("doc_id").cast("string")), F.lit(".txt"))
    files = docs.where("doc_id is not null").select(place.alias("path"), "text")
    short = F.length("text") <= LICENCE_FILE_CHARS
    found = scan(files, short & F.lower("text").rlike("licen[cs]e"))
    number = F.regexp_extract("path", "([0-9-]+)[.]txt$", 1).cast("long")
    return found.withColumn("doc_id", number).withColumn("similarity", F.round("similarity", 6))


def op2_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pseudonymise(table(spark, folder, "documents"), secret_of(spark)).select("doc_id", "text", "n_found")


def op3_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents"), table(spark, folder, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly"
    )


def labelled_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Labels belong to documents, whose id a page's URL ends in; bad or toxic ones are examples of what to block."""
    pages = table(spark, folder, "pages").select("url")
    known = table(spark, folder, "labels").select("doc_id", F.when((F.col("quality") == 0) | (F.col("toxic") == 1), BLOCK).otherwise(ALLOW).alias("verdict"))
    named = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:[.]html)?/?$", 1)
    return pages.where(named != "").select("url", named.cast("long").alias("doc_id")).join(known, "doc_id").select("url", "verdict")


def op5_urls(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), labelled_urls(spark, folder))


def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), tokenizer_path())


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    formatted = format_conversations(turns)
    again = read_back(formatted)
    said = F.expr("array_join(transform(turns, t -> concat(t.role, '\\n', t.text, '\\n')), '')")
    loss = F.array_join("loss_texts", "")
    return again.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_decontam(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("key")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lexicon = tox.fit(docs, table(spark, folder, "labels"))
    return tox.toxicity(docs.select("doc_id", "text"), lexicon).select(
        "doc_id", tox.held_out_rows(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every hundredth vector is an anchor; a seventh of the labels is moved on by one."""
    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0, label=label)


def op12_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_licences": op1_licences,
    "op2_pseudonyms": op2_pseudonyms,
    "op3_near_dup": op3_near_dup,
    "op4_quality": op4_quality,
    "op5_urls": op5_urls,
    "op6_main_text": op6_main_text,
    "op7_packing": op7_packing,
    "op8_chat": op8_chat,
    "op9_decontam": op9_decontam,
    "op10_toxicity": op10_toxicity,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_language": op12_language,
    "op13_spelling": op13_spelling,
}
