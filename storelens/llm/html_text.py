"""Main text of web pages: flat text blocks, judged by a decision tree.

A page is cut into flat blocks at block-level tags. Each block has its word count and link density, those
of the blocks before and after it, whether it is a heading, and signs of where it stands: inside something
that its tag or its class names call furniture (menus, adverts, comments, forms), inside something with a
name that may mean furniture or not (a share bar, a post's header), and inside, outside or without an
element that holds the article. A decision tree, trained by Spark ML on the labelled pages that
``examples`` lays out (a few thousand blocks, by a fixed seed), says which blocks are main text. Where a page
names nothing, or its names are doubtful, word counts and link densities decide.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm.shared import only

FEATURES = [
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "furniture", "doubtful", "place", "heading",
]

# Elements whose content is no text, that are furniture, and that stay within a block.
SILENT = "script|style|noscript|template|svg|math|iframe|object|canvas|audio|video|textarea|select|title"
FURNITURE = {"nav", "header", "footer", "aside", "form", "menu", "button", "dialog", "fieldset"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "input", "ins",
    "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# Elements that hold the article, the surest first; a class, id or role that says so is the least sure.
HOLDERS = ("article", "main", "named")
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Words in class, id or role that name furniture, that may name it, and that name the article.
FURNITURE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|captcha|comments?|complementary|consent|contentinfo|cookies?|disqus|footer|gdpr|login|menu|"
    r"modal|nav\w*|newsletter|notice|pager|pagination|popup|promo\w*|replies|respond|sidebar|signup|sponsor\w*|subscribe|toolbar)(?:$|[\s_-])", re.I)
DOUBTFUL_NAMES = re.compile(r"(?:^|[\s_-])(?:header|more|related|reply|search|share|sharing|social|tags?|widget)(?:$|[\s_-])", re.I)
ARTICLE_NAMES = re.compile(r"(?:^|[\s_-])(?:article|articlebody|content|entry|main|post|story)(?:$|[\s_-])", re.I)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<silent>" + SILENT + r")\b(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*>.*?(?:</(?P=silent)\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<close>[a-zA-Z][\w:-]*)[^>]*(?:>|\Z)|<(?P<open>[a-zA-Z][\w:-]*)(?P<attributes>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*)(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none|visibility\s*:\s*hidden""", re.I)
_MAIN = re.compile(r"\bdata-main\b")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    furniture: bool
    doubtful: bool
    holders: frozenset[str]
    heading: bool
    main: bool


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page in order; broken and unclosed markup is taken as it comes."""
    found: list[Block] = []
    # Open elements: name, furniture, doubtful, what holder of an article it is, labelled as main.
    opened: list[tuple[str, bool, bool, str, bool]] = []
    furniture = doubtful = heading = main = False
    holders: frozenset[str] = frozenset()
    links = 0
    parts: list[str] = []
    linked: list[str] = []

    def finish():
        nonlocal parts, linked
        if parts:
            words = "".join(parts).split()
            if words:
                found.append(Block(" ".join(words), len(words), len("".join(linked).split()), furniture, doubtful, holders, heading, main))
            parts, linked = [], []

    def say(text: str):
        if "&" in text:
            text = html.unescape(text)
        parts.append(text)
        if links:
            linked.append(text)

    def settle():
        nonlocal furniture, doubtful, holders, heading, main
        furniture = any(o[1] for o in opened)
        doubtful = any(o[2] for o in opened)
        # An article inside furniture is a teaser or a comment.
        holders = frozenset() if furniture else frozenset(o[3] for o in opened if o[3])
        main = any(o[4] for o in opened)
        heading = any(o[0] in HEADINGS for o in opened)

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            say(page[at:token.start()])
        at = token.end()
        name = token["open"]
        if name:
            name = name.lower()
            if name in INLINE:
                if name == "a":
                    links += 1
                elif name == "br":
                    parts.append(" ")
                continue
            finish()
            links = 0
            attributes = token["attributes"]
            if name in VOID or attributes.endswith("/"):
                continue
            odd, unsure, labelled = name in FURNITURE, False, False
            holder = name if name in HOLDERS else ""
            if name == "header" and any(o[3] in ("article", "main") and not o[1] for o in opened):
                odd = False
            if attributes:
                names = " ".join(m.strip("\"'") for m in _NAMES.findall(attributes))
                if names and name not in ("body", "html", "article", "main"):
                    odd = odd or bool(FURNITURE_NAMES.search(names))
                    unsure = bool(DOUBTFUL_NAMES.search(names))
                    holder = "named" if ARTICLE_NAMES.search(names) and not odd and not unsure else ""
                odd = odd or bool(_HIDDEN.search(attributes))
                labelled = bool(_MAIN.search(attributes))
            # A paragraph or list item closes an open one of its kind.
            if name in ("p", "li", "td", "th", "tr", "dt", "dd", "option") and opened and opened[-1][0] == name:
                opened.pop()
            opened.append((name, odd, unsure, holder, labelled))
            settle()
        elif token["close"]:
            name = token["close"].lower()
            if name in INLINE:
                if name == "a" and links:
                    links -= 1
                continue
            finish()
            links = 0
            for k in range(len(opened) - 1, -1, -1):
                if opened[k][0] == name:
                    del opened[k:]
                    settle()
                    break
        elif token["silent"]:
            parts.append(" ")
    if at < len(page):
        say(page[at:])
    finish()
    return found


def features(found: list[Block]) -> np.ndarray:
    words = np.array([b.words for b in found], float)
    density = np.array([b.linked / b.words for b in found], float)
    before = lambda x: np.concatenate([[0.0], x[:-1]])
    after = lambda x: np.concatenate([x[1:], [0.0]])
    flags = {f: np.array([getattr(b, f) for b in found], float) for f in ("furniture", "doubtful", "heading")}
    held = next((h for h in HOLDERS if any(h in b.holders for b in found)), None)
    # One inside the surest kind of holder that the page has, nought outside, a half on a page without any.
    place = np.array([float(held in b.holders) if held else 0.5 for b in found])
    return np.stack(
        [words, density, before(words), before(density), after(words), after(density), flags["furniture"], flags["doubtful"], place, flags["heading"]], axis=1)


_WORDS = "the quick brown fox jumps over the lazy dog while a band plays on and nobody minds rain that falls all day long near our old town".split()
# How the pages of ``examples`` name what holds the article, the last one not at all.
_OPENINGS = ("<article>", "<main>", "<div class=content>", "<div class=post-body>", "<div>")


def examples(pages: int = 400, seed: int = 7) -> list[str]:
    """Labelled pages of all layouts: what stands under ``data-main`` is main text.

    Every page has link lists, short lines and long texts beside its article, with names that call them furniture,
    doubtful names or none; and an article that has short lines, lists, partly linked texts and, under names
    that only sound like furniture, headlines and texts.
    """
    rng = random.Random(seed)

    def say(least: int, most: int) -> str:
        return " ".join(rng.choice(_WORDS) for _ in range(rng.randint(least, most)))

    def link(least: int = 1, most: int = 6) -> str:
        return f"<a href=x>{say(least, most)}</a>"

    def long(mark: str = "") -> str:
        return f"<p{mark}>{say(14, 90)}</p>"

    def links(name: str = "") -> str:
        """Three linked lines or more, now and then with a caption."""
        tag = rng.choice(("div", "p", "li"))
        head = rng.choice(("", f"<h3><a href=x>{say(1, 3)}</a></h3>"))
        return f"<div{name}>{head}" + "".join(f"<{tag}>{link(1, 14)}</{tag}>" for _ in range(rng.randint(3, 7))) + "</div>"

    def marked(name: str) -> str:
        return f"<div class='{name}'>{rng.choice((long, links))()}<p>{say(1, 8)}</p></div>"

    made = []
    for number in range(pages):
        opening = _OPENINGS[number % len(_OPENINGS)]
        named = opening != _OPENINGS[-1]
        main = " data-main"
        inside = [rng.choice((f"<h1{main}>{say(2, 9)}</h1>", f"<div class={rng.choice(('post-header', 'entry-header'))}><h1{main}>{say(2, 9)}</h1></div>"))]
        for _ in range(rng.randint(2, 5)):
            inside.append(long(main))
            kinds = [
                f"<p{main}>{say(2, 10)} {link(1, 2)} {say(4, 10)}</p>", f"<div class={rng.choice(('social-history', 'search-theory', 'tag-words'))}>{long(main)}</div>",
                f"<h2{main}>{say(1, 6)}</h2>{long(main)}", f"<ul>{''.join(f'<li{main}>{say(2, 9)}</li>' for _ in range(rng.randint(1, 4)))}</ul>{long(main)}",
                f"<p{main}>{say(1, 7)}</p>{long(main)}",
            ]
            if named:
                # Furniture stands among the article's own blocks, and so do single linked lines.
                kinds += [f"<p{main}>{link(2, 8)}</p>{long(main)}", f"<p{main}>{say(1, 9)}</p><p{main}>{link(1, 8)}</p><p{main}>{say(1, 9)}</p>", marked(rng.choice(("comments", "cookie-notice", "ad", "newsletter"))), links(), f"<p{main}>{say(1, 4)}</p>"]
            kinds += [links(f" class={rng.choice(('share-bar', 'social', 'related', 'tags'))}")]
            inside.append(rng.choice(kinds))
        if rng.random() < 0.3:
            inside.append(f"<aside>{long()}</aside><form><p>{say(2, 20)}</p></form>")
        inside.append(long(main))
        if named:
            # The article may end in anything of its own, and may be all short lines.
            ends = [f"<p{main}>{say(1, 8)}</p>", f"<ul><li{main}>{say(1, 5)}<li{main}>{say(1, 5)}</ul>", f"<p{main}>{link(2, 8)}</p>", f"<div class=social-history>{long(main)}</div>", ""]
            ends += [f"{links()}{long(main)}", f"{links()}<p{main}>{say(1, 8)}</p>", f"<p{main}>{say(1, 8)}</p><p{main}>{link(1, 8)}</p>{marked('ad')}"]
            inside.append(rng.choice(ends))
            if rng.random() < 0.2:
                inside = [f"<p{main}>{say(1, 12)}</p>" for _ in range(rng.randint(1, 9))]
        before = rng.choice((links(), f"<nav>{links()}</nav>", f"<header><p>{say(1, 4)}</p>{links()}</header>", f"<div class=menu>{links()}</div>"))
        after = [links(), rng.choice((f"<p>{say(1, 4)}</p>", f"<footer><p>{say(2, 30)}</p></footer>", f"<div class=sidebar>{long()}</div>"))]
        if named:
            # Comments that nothing names, outside what holds the article.
            after.insert(1, f"<section>{long()}<p>{say(1, 12)}</p></section>")
        if rng.random() < 0.3:
            after = []
        elif inside[-1].endswith("</a></p>"):
            # A linked line before a list of links would be one of the list.
            after = after[1:]
        made.append(f"<body>{before}{opening}{''.join(inside)}</{opening[1:].split('>')[0].split()[0]}>{''.join(after)}</body>")
    return made


class Tree:
    """A fitted tree as flat arrays, so that tasks need no Spark model."""

    def __init__(self, model):
        rows: list[list[float]] = []

        def walk(node) -> int:
            me = len(rows)
            rows.append([-1, 0.0, 0, 0, node.prediction()])
            if node.getClass().getSimpleName() != "LeafNode":
                split = node.split()
                rows[me][:2] = [split.featureIndex(), split.threshold()]
                rows[me][2] = walk(node.leftChild())
                rows[me][3] = walk(node.rightChild())
            return me

        walk(model._call_java("rootNode"))
        table = np.array(rows)
        self.which, self.cut = table[:, 0].astype(int), table[:, 1]
        self.left, self.right, self.value = table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4]

    def predict(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), int)
        live = np.flatnonzero(self.which[at] >= 0)
        while len(live):
            node = at[live]
            at[live] = np.where(rows[live, self.which[node]] <= self.cut[node], self.left[node], self.right[node])
            live = live[self.which[at[live]] >= 0]
        return self.value[at]


def train(spark: SparkSession, pages: list[str] | None = None, depth: int = 10) -> Tree:
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = []
    for page in examples() if pages is None else pages:
        found = blocks(page)
        rows += [(*map(float, f), float(b.main)) for f, b in zip(features(found), found)]
    table = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in [*FEATURES, "label"])).coalesce(1)
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table)
    return Tree(DecisionTreeClassifier(maxDepth=depth, maxBins=64, minInstancesPerNode=3, seed=7).fit(table))


def _extract(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [blocks(p) if p else [] for p in batch.column(2).to_pylist()]
            filled = [b for b in pages if b]
            keep = tree.predict(np.concatenate([features(b) for b in filled])) > 0.5 if filled else np.empty(0, bool)
            texts, at = [], 0
            for found in pages:
                texts.append("\n\n".join(b.text for b, main in zip(found, keep[at:at + len(found)]) if main))
                at += len(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return run


def extract_text(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``, row by row.

    Blocks are decoded, their white space made single blanks, and joined by an empty line. Null and
    empty pages, and pages without main text, have an empty text. Repeated rows get equal results;
    other columns are ignored.
    """
    tree = tree or train(pages.sparkSession)
    rows = only(pages, ["page_id", "url", "html"]).withColumn("page_id", F.col("page_id").cast("long"))
    made = rows.mapInArrow(_extract(tree), "page_id long, url string, text string")
    return made.withColumn("n_chars", F.length("text").cast("long"))
