import itertools
import math
import random
import re
from collections import Counter

from conftest import DATA
from storelens.llm.queries import labelled_urls, op5_urls
from storelens.llm.url_filter import CONFIDENCE, RULES, SUPPORT, judge_urls, mine, tokens_of
from pyspark.sql import functions as F


def brute_force(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fitting = []
    for verdict, rule in RULES:
        at, slash, tail = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith(slash + tail):
            fitting.append((len(rule), rule, verdict))
    return host, path, max(fitting)[1] if fitting else None, max(fitting)[2] if fitting else None


def check(rows, urls):
    for r in rows:
        host, path, rule, verdict = brute_force(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")


def test_listed_rules_on_all_pages(spark):
    pages = spark.read.parquet(f"{DATA}/sf0.1/pages.parquet")
    urls = {r["page_id"]: r["url"] for r in pages.collect()}
    rows = op5_urls(spark, f"{DATA}/sf0.1").collect()
    assert len(rows) == len(urls)
    check(rows, urls)


def test_mined_rules_judge_what_the_list_leaves(spark):
    rng = random.Random(9)
    urls, labels = [], []
    for k in range(3000):
        spam, ad = rng.random() < 0.2, rng.random() < 0.2
        host = f"{'win-cash' if spam else 'daily'}.site{k % 7}.example.com"
        path = f"/{'ads' if ad else 'en'}/{k}"
        urls.append((k, f"https://{host}{path}"))
        # Blocked when the host wins cash, or advertises in English pages' place with rare slips.
        if k % 2:
            labels.append((urls[-1][1], "block" if (spam or ad) != (rng.random() < 0.02) else "allow"))
    known = spark.createDataFrame(labels, "url string, verdict string")
    model = mine(known).collect()
    assert {"host:win", "host:cash"} & {t for r in model if r["verdict"] == "block" for t in r["tokens"]}
    assert all(r["index"] in r["tokens"] and r["confidence"] >= 0.6 for r in model)
    rows = judge_urls(spark.createDataFrame(urls, "page_id long, url string"), known).collect()
    wrong = sum(r["verdict"] != ("block" if r["host"].startswith("win") or r["path"].startswith("/ads") else "allow") for r in rows)
    assert wrong == 0


def test_corner_rows(spark):
    urls = [None, "", "no scheme", "http://", "x://A.NET", "http://NET/", "http://a.net/x?y#z", "http://xnet/", "HTTP://É.Example.NET/en/1", "http://example.net/en", "a://b://c.org/fr/", "http://c.org/fr/x\ny?z",
            "http://net?/", "http://example.com/de/" + "a" * 50_000]
    rows = [(k, u, "r", "v", "h") for k, u in enumerate(urls)] + [(6, urls[6], "r", "v", "h"), (None, urls[6], "r", "v", "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, verdict string, host string")
    for labels in ([], [(None, "block"), ("http://z.com/", None), ("http://z.com/", "block")]):
        found = judge_urls(pages, spark.createDataFrame(labels, "url string, verdict string")).collect()
        assert len(found) == len(rows)
        check([r for r in found if r["page_id"] is not None], dict(enumerate(urls)))
    none = spark.createDataFrame([], pages.schema)
    assert judge_urls(none, spark.createDataFrame([], "url string, verdict string")).count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([("https://www.cheap-pills.example.com/en/12.html?page=2&ref=x#top",)], "url string")
    assert set(df.select(tokens_of(F.col("url"))).first()[0]) == {
        "host:www", "host:cheap", "host:pills", "host:example", "host:com", "path:en", "path:0.html", "query:page", "query:ref", "scheme:https"}


def parts_of(tokens):
    return (c for n in range(1, len(tokens) + 1) for c in itertools.combinations(tokens, n))


def test_all_rules_of_the_given_table_judge(spark):
    """Every rule by counting all token sets, none cut before the redundant ones go."""
    folder = f"{DATA}/sf0.1"
    rows = [(tuple(sorted(r["tokens"])), r["verdict"]) for r in labelled_urls(spark, folder).select(tokens_of(F.col("url")).alias("tokens"), "verdict").collect()]
    labels, sets, joint = Counter(v for _, v in rows), Counter(), Counter()
    for tokens, verdict in rows:
        sets.update(parts_of(tokens))
        joint.update((c, verdict) for c in parts_of(tokens))
    rules = {(c, v): n / sets[c] for (c, v), n in joint.items()
             if n >= math.ceil(SUPPORT * len(rows)) and n / sets[c] >= CONFIDENCE and n / sets[c] > labels[v] / len(rows)}
    kept = {(c, v): (x, joint[c, v]) for (c, v), x in rules.items() if not any(rules.get((p, v), 0) >= x for p in parts_of(c) if len(p) < len(c))}
    model = mine(labelled_urls(spark, folder)).collect()
    assert {(tuple(r["tokens"]), r["verdict"]) for r in model} == kept.keys()
    assert {r["verdict"] for r in model} == {"allow", "block"}

    urls = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", tokens_of(F.col("url")).alias("tokens")).collect()
    tokens, mined = {r["page_id"]: set(r["tokens"]) for r in urls}, 0
    for r in op5_urls(spark, folder).collect():
        if r["rule"] is None:
            holding = [(x, n, c, v) for (c, v), (x, n) in kept.items() if tokens[r["page_id"]].issuperset(c)]
            assert r["verdict"] == (max(holding)[3] if holding else "allow")
            mined += r["verdict"] == "block"
    assert mined > 0
