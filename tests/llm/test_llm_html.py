import html
import re

from conftest import DATA
from storelens.llm.html_text import FEATURES, blocks, examples, extract_text, features, train


def article_of(page):
    found = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)
    parts = re.split(r"</?(?:p|h1)>", found.group(1) if found else "")
    plain = (re.sub(r"<[^>]*(?:>|\Z)", lambda m: " " if m.group(0).startswith("<br") else "", p) for p in parts)
    return "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in plain) if t)


def text_of(spark, *pages):
    df = spark.createDataFrame([(k, "u", p, "t", 0) for k, p in enumerate(pages)], "page_id long, url string, html string, text string, n_chars int")
    return [r["text"] for r in sorted(extract_text(df).collect(), key=lambda r: r["page_id"])]


def test_articles_of_the_pages(spark):
    pages = spark.read.parquet(f"{DATA}/sf0.1/pages.parquet")
    want = {r["page_id"]: article_of(r["html"]) for r in pages.collect()}
    rows = extract_text(pages).collect()
    assert len(rows) == len(want)
    for r in rows:
        assert r["text"] == want[r["page_id"]] and r["n_chars"] == len(r["text"])


def test_held_out_layouts(spark):
    tree = train(spark)
    right, total = 0, 0
    for page in examples(pages=200, seed=99):
        found = blocks(page)
        verdict = tree.predict(features(found)) > 0.5
        right, total = right + int((verdict == [b.main for b in found]).sum()), total + len(found)
    assert total > 2000 and right / total > 0.95


def test_the_tree_reads_densities_and_neighbours(spark):
    cuts = {FEATURES[k] for k in train(spark).which if k >= 0}
    assert {"words", "link_density"} <= cuts
    assert cuts & {"link_density_before", "link_density_after"} and cuts & {"words_before", "words_after"}


def test_densities_decide_where_names_do_not(spark):
    words = "the town council met on monday and spoke about the new bridge across the river which many people want"
    parts = [f"{w} {words}" for w in ("first", "second", "third")]
    links = "".join(f"<div><a href=x>{w} and more news</a></div>" for w in ("sport", "money", "weather", "travel"))
    body = "".join(f"<p>{p}</p>" for p in parts)
    comment = f"<div><p>reader one: {words}</p></div><section><p>a reply: {words}</p></section>"
    got = text_of(
        spark,
        f"<body>{links}<div>{body}</div>{links}</body>",
        f"<body><article><h1>A headline</h1>{body}</article>{comment}</body>",
        f"<body><article><div class='post-header'><h1>A headline</h1></div>{body}<div class=social-history><p>{words}</p></div></article></body>",
        f"<body><article>{body}<address>Written in the old town hall</address><p><label>A label in the text</label></p><p>{words}</p></article></body>",
        f"<body><article>{body}<div class=share>{links}</div>{links}<p>{words}</p></article></body>",
        f"<body><main><article><h1>A headline</h1>{body}</article>{comment}</main></body>",
    )
    text = "\n\n".join(parts)
    assert got[0] == text
    assert got[1] == got[5] == f"A headline\n\n{text}"
    assert got[2] == f"A headline\n\n{text}\n\n{words}"
    assert got[3] == f"{text}\n\nWritten in the old town hall\n\nA label in the text\n\n{words}"
    assert got[4] == f"{text}\n\n{words}"


def test_markup(spark):
    long = "This is a sentence with quite a number of words that goes on for a while and tells something."
    got = text_of(
        spark,
        f"<article><p>a&amp;amp;b &lt;i&gt; &copy; &#233;</p><p>x<b>y</b>z <i>q</i><br/>next\n\n line</p><!-- <p>no</p> --><script>var a='<p>no</p>';</script><p>{long}</article><p>out",
        f"<nav><p>{long}</p></nav><main><h2>T</h2><p>{long}</p><div class='reader comments'><p>{long}</p></div><ul><li>one<li>two</ul></main>",
        f"<article><p>{long}<p>cut in the mid",
        f"<ARTICLE CLASS=story><P title='a > b'>{long}</P><aside>{long}</aside><p hidden>{long}</p><form>{long}</form></ARTICLE>",
        f"<article><p>{long}</p><p class=\"ad\">{long}</p><p>short</p><a href=x>only a link</a></article> <div id=cookie-notice>{long}</div><di",
    )
    assert got == [
        f"a&amp;b <i> © é\n\nxyz q next line\n\n{long}", f"T\n\n{long}\n\none\n\ntwo", f"{long}\n\ncut in the mid", long, f"{long}\n\nshort\n\nonly a link",
    ]


def test_corner_rows(spark):
    big = "<article><p>" + "</p><p>".join(f"paragraph number {k} of a long page" for k in range(20_000)) + "</p></article>"
    got = text_of(spark, None, "", "no markup at all", "<html></html>", "<<<>>><p", big, "<a href='x>broken</a> \" <p>", "<!-- never closed <p>x</p>")
    assert got[0] == got[1] == got[3] == got[7] == ""
    assert got[5].count("\n\n") == 19_999
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract_text(df).count() == 0
