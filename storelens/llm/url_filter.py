"""URL filters: a rule list first, association rules mined by FP-growth for the rest.

Every URL is read as a set of tokens: its host's ending and words, the language and kind of its path, its
query keys. Spark's FP-growth mines the token sets of labelled URLs together with their label; a rule
``tokens -> label`` stays if its support and confidence are high enough and no rule with fewer tokens is
as confident. Rules are found again by an inverted index: each is filed under its rarest token, joined on
the tokens of the URL, and holds if all its tokens are there. The most confident rule decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.shared import hashed_sample, only, write_once

BLOCK, ALLOW = "block", "allow"
# The rule list: verdict, and host with path; a rule fits the host and its subdomains.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# Bound of the sample of labelled URLs that FP-growth mines.
MOST_ROWS = 50_000
SUPPORT, CONFIDENCE = 0.002, 0.6

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def host_endings(host: Column) -> Column:
    """``a.b.c``, ``b.c`` and ``c``."""
    labels = F.split(host, "[.]")
    return F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))


def tokens_of(url: Column) -> Column:
    """The tokens of a URL that rules may speak of; numbers are one token, and the last path part is only its kind."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, "[.]")
    words = F.flatten(F.transform(labels, lambda x: F.split(x, "-")))
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    named = F.transform(parts, lambda x: F.concat(F.lit("path:"), F.when(x.rlike("[0-9]"), F.regexp_replace(x, "[0-9]+", "0")).otherwise(x)))
    query = F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#?]+)="), 1)
    made = F.concat(
        F.transform(F.filter(words, lambda x: x != ""), lambda x: F.concat(F.lit("host:"), x)), named,
        F.transform(query, lambda x: F.concat(F.lit("query:"), x)),
        F.array(F.concat(F.lit("scheme:"), F.regexp_extract(F.coalesce(url, F.lit("")), "^([A-Za-z]+)://", 1))),
    )
    return F.array_distinct(made)


def listed(urls: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``url, rule, ruled``: the longest rule that fits each URL, for those with one."""
    split = [(verdict, rule, rule.partition("/")[0], "/" + rule.partition("/")[2]) for verdict, rule in rules]
    table = urls.sparkSession.createDataFrame(split or [("", "", "", "")], "ruled string, rule string, ending string, start string")
    places = urls.select("url", "path", F.explode(host_endings(F.col("host"))).alias("ending"))
    fitting = places.join(table.where("rule <> ''"), "ending").where(F.col("path").startswith(F.col("start")))
    return fitting.groupBy("url").agg(F.max_by(F.struct("rule", "ruled"), F.struct(F.length("rule"), "rule")).alias("r")).select("url", "r.rule", "r.ruled")


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, most_rows: int = MOST_ROWS) -> DataFrame:
    """``verdict, tokens, index, confidence, support`` of the rules in ``labelled(url, verdict)``.

    Mines at most ``most_rows`` labelled URLs, by hash. ``index`` is the rule's rarest token. All rules
    with enough support and confidence stay, unless one with fewer of their tokens covers them.
    """
    rows = hashed_sample(only(labelled, ["url", "verdict"]).where("url is not null and verdict is not null"), ["url"], most_rows)
    from pyspark.ml.fpm import FPGrowth

    label = F.concat(F.lit("="), F.col("verdict"))
    baskets = write_once(rows.select(F.array_union(tokens_of(F.col("url")), F.array(label)).alias("items")), "url-baskets")
    if baskets.isEmpty():
        return baskets.sparkSession.createDataFrame([], "verdict string, tokens array<string>, index string, confidence double, support double")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    found = model.associationRules.where(F.element_at("consequent", 1).startswith("=")).where("not exists(antecedent, x -> startswith(x, '='))")
    found = write_once(found.where("lift > 1").select(
        F.expr("substring(consequent[0], 2)").alias("verdict"), F.sort_array("antecedent").alias("tokens"), "confidence", "support"), "url-rules")
    single = model.freqItemsets.where("size(items) = 1").select(F.col("items")[0].alias("token"), "freq")
    rarest = found.select("verdict", "tokens", F.explode("tokens").alias("token")).join(single, "token").groupBy("verdict", "tokens").agg(
        F.min_by("token", F.struct("freq", "token")).alias("index"))
    filed = write_once(found.join(rarest, ["verdict", "tokens"]).select("verdict", "tokens", "index", "confidence", "support"), "url-filed-rules")
    # A rule goes if part of its tokens says the same with no less confidence; such a part is filed under one of its tokens.
    a, b = filed.withColumn("token", F.explode("tokens")).alias("a"), filed.alias("b")
    covered = a.join(b, (F.col("a.token") == F.col("b.index")) & (F.col("a.verdict") == F.col("b.verdict")) & (F.size("b.tokens") < F.size("a.tokens"))
                     & (F.col("b.confidence") >= F.col("a.confidence")) & (F.size(F.array_except("b.tokens", "a.tokens")) == 0), "left_semi")
    return write_once(filed.join(covered.select("verdict", "tokens").distinct(), ["verdict", "tokens"], "left_anti"), "url-model")


def matched(urls: DataFrame, model: DataFrame) -> DataFrame:
    """``url, mined``: the verdict of the most confident rule of the model that holds, for URLs with one."""
    tokens = urls.select("url", tokens_of(F.col("url")).alias("have"))
    hits = tokens.select("url", "have", F.explode("have").alias("index")).join(model, "index").where("size(array_except(tokens, have)) = 0")
    best = F.max_by("verdict", F.struct("confidence", "support", "tokens"))
    return hits.groupBy("url").agg(best.alias("mined"))


def judge_urls(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str]] = RULES, default: str = ALLOW) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages(page_id, url)``.

    ``verdict`` is the listed rule's, else the mined rules', else ``default``. Null URLs, and those
    without ``://``, have an empty host and path and get the default. Each distinct URL is judged
    once, however many rows have it. Without labels only the list speaks. Other columns are ignored.
    """
    rows = only(pages, ["page_id", "url"])
    urls = rows.where("url is not null").select("url").distinct().withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    by_list = listed(urls, rules)
    by_rules = matched(urls.join(by_list.select("url"), "url", "left_anti").select("url"), mine(labelled))
    verdicts = by_list.select("url", "rule", F.col("ruled").alias("verdict")).unionByName(
        by_rules.select("url", F.lit(None).cast("string").alias("rule"), F.col("mined").alias("verdict"))
    )
    return rows.join(verdicts, "url", "left").select(
        F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
