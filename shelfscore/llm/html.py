"""Main text of web pages: flat text blocks classified by a decision tree.

A page is parsed into a flat list of text blocks in page order: a block ends
at every block-level tag. Each block carries its word count, its link density
(share of its words inside links), the same two figures of the blocks before
and after it, whether it is a heading, whether an element around it marks
page furniture (navigation, footers, sidebars, forms, notices, adverts,
comments, by tag, role or class and id words), and whether an article or main
element holds it. A decision tree, trained with Spark ML on a small labelled
table of pages whose main text is marked, says which blocks are main text. The
tree is turned into one column expression, so the blocks are judged where the
page lies: no shuffle, no block table.

Defined cases: a null html is empty and gives an empty text; script, style,
template, noscript, head and comments never give text; character references
are decoded; white space inside a block becomes one space, blocks are joined
by one space; a page without any main text gives the empty string. Repeated
rows give equal rows. Extra input columns are ignored. A very long page is
parsed in one pass, its blocks are as many as its block tags.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscore.llm.storage import bounded_batches

__all__ = ["BLOCK_SCHEMA", "FEATURES", "blocks_of", "extract_main_text", "page_blocks", "train_tree", "tree_column"]

# Tags that end a block, tags whose content is never text, tags
# and roles of page furniture, and words of class and id values that mark it.
BLOCK_TAGS = set(
    "address article aside blockquote body br caption dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
SKIP_TAGS = set("head script style template noscript svg iframe object select textarea title".split())
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE_TAGS = set("nav footer aside form button dialog menu".split())
FURNITURE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu".split())
MAIN_TAGS = {"article", "main"}
MAIN_ROLES = {"main", "article"}
FURNITURE_WORDS = set(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer menu modal nav navbar navigation newsletter notice popup promo related replies reply respond "
    "share sidebar social sponsor sponsored subscribe widget".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

FEATURES = [
    "words",
    "link_density",
    "prev_words",
    "prev_link_density",
    "next_words",
    "next_link_density",
    "heading",
    "furniture",
    "in_main",
]
BLOCK_SCHEMA = (
    "array<struct<text:string,words:double,link_density:double,prev_words:double,prev_link_density:double,"
    "next_words:double,next_link_density:double,heading:double,furniture:double,in_main:double,label:double>>"
)

_WORD_CUT = re.compile(r"[\s\-_]+")


class _Blocks(HTMLParser):
    """Flat text blocks of one page with the marks of the elements around them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, bool, float | None]] = []
        self.skip = 0
        self.parts: list[str] = []
        self.link_words = 0
        self.links = 0
        self.found: list[dict] = []
        self.heading = False

    def _marks(self) -> tuple[bool, bool, float]:
        """Marks of the innermost open element; each holds those of its
        ancestors, so a deep page costs no walk."""
        if not self.stack:
            return False, False, 0.0
        _, furniture, main, label = self.stack[-1]
        return furniture, main, 0.0 if label is None else label

    def _flush(self) -> None:
        text = " ".join(" ".join(self.parts).split())
        if text:
            words = len(text.split())
            furniture, main, label = self._marks()
            self.found.append(
                {
                    "text": text,
                    "words": float(words),
                    "link_density": min(1.0, self.link_words / words),
                    "heading": float(self.heading),
                    "furniture": float(furniture),
                    "in_main": float(main),
                    "label": float(label),
                }
            )
        self.parts, self.link_words, self.heading = [], 0, False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "body":  # ends a head left open
            self.skip = 0
        if tag in SKIP_TAGS:
            if tag not in VOID_TAGS:
                self.skip += 1
            return
        if tag in BLOCK_TAGS:
            self._flush()
        if tag in VOID_TAGS:
            return
        values = dict(attrs)
        words = set(_WORD_CUT.split(f"{values.get('class') or ''} {values.get('id') or ''}".lower()))
        role = (values.get("role") or "").lower()
        _, outer_furniture, in_main, outer_label = self.stack[-1] if self.stack else ("", False, False, None)
        furniture = outer_furniture or (
            tag in FURNITURE_TAGS
            or (tag == "header" and not in_main)
            or role in FURNITURE_ROLES
            or bool(words & FURNITURE_WORDS)
            or "hidden" in values
            or (values.get("aria-hidden") or "").lower() == "true"
        )
        main = in_main or tag in MAIN_TAGS or role in MAIN_ROLES
        mark = values.get("data-label")
        label = outer_label if mark is None else float(mark == "main")
        self.stack.append((tag, furniture, main, label))
        if tag == "a":
            self.links += 1
        if tag in HEADINGS:
            self.heading = True

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK_TAGS and tag not in SKIP_TAGS:
            self._flush()

    def handle_endtag(self, tag: str) -> None:
        if tag in SKIP_TAGS:
            self.skip = max(0, self.skip - 1)
            return
        if tag in BLOCK_TAGS:
            self._flush()
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                for name, *_ in self.stack[at:]:
                    if name == "a":
                        self.links -= 1
                del self.stack[at:]
                break

    def handle_data(self, data: str) -> None:
        if self.skip:
            return
        self.parts.append(data)
        if self.links > 0:
            self.link_words += len(data.split())

    def close(self) -> list[dict]:
        super().close()
        self._flush()
        return self.found


def blocks_of(html: str | None) -> list[dict]:
    """The blocks of one page in page order, with the figures of their
    neighbours (0 before the first and after the last)."""
    parser = _Blocks()
    parser.feed(html or "")
    found = parser.close()
    for k, block in enumerate(found):
        before = found[k - 1] if k > 0 else None
        after = found[k + 1] if k + 1 < len(found) else None
        block["prev_words"] = before["words"] if before else 0.0
        block["prev_link_density"] = before["link_density"] if before else 0.0
        block["next_words"] = after["words"] if after else 0.0
        block["next_link_density"] = after["link_density"] if after else 0.0
    return found


def page_blocks(pages: DataFrame, keys: list[str], html_col: str = "html") -> DataFrame:
    """(keys..., blocks): the key columns of every page with its blocks (an
    array of block structs) in place of the html; a null html has none. Pages
    are parsed where they lie."""
    bounded_batches(pages.sparkSession)
    kept = pages.select(*keys, F.col(html_col).alias("__html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name in keys)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = batch[keys].copy()
            found["blocks"] = [blocks_of(h) for h in batch["__html"].tolist()]
            yield found

    return kept.mapInPandas(parse, f"{schema}, blocks {BLOCK_SCHEMA}")


# ---- the labelled table and the tree ---------------------------------------

# Small labelled pages: main text is marked data-label="main", all else is not.
# The marks only label blocks; they are no feature.
LABELLED_PAGES = [
    """<html><head><title>Rivers</title></head><body>
<nav><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/sport">Sport</a></li></ul></nav>
<div class="ad">Buy the best boots now at half price today only.</div>
<article data-label="main"><h1>How rivers shape their valleys</h1>
<p>Rivers cut into rock slowly, carrying sand and stones that grind the bed deeper with every flood season.</p>
<p>Over thousands of years the valley widens as the banks slip and the water moves from side to side.</p>
<p>Short note.</p><p>See <a href="/map">the map</a> and <a href="/photos">the photos</a>.</p></article>
<footer>&copy; example.org &middot; <a href="/about">About</a> <a href="/terms">Terms</a></footer></body></html>""",
    """<html><body><header><div class="logo">Daily Paper</div><a href="/login">Log in</a></header>
<div id="cookie-notice">We use cookies to improve your experience. Accept all cookies?</div>
<div class="content" data-label="main"><h2>The market opened higher</h2>
<p>Shares rose in early trading on Monday as investors weighed the latest figures on prices and jobs.</p>
<p>Analysts said the move was expected after a week of losses, and warned that the rally could fade quickly.</p>
<p>Trading volumes were lower than usual because of the holiday in several countries.</p></div>
<aside><h3>Related</h3><ul><li><a href="/a">Banks cut rates</a></li><li><a href="/b">Oil falls again</a></li></ul></aside>
<section class="comments"><h3>Comments</h3><div class="comment"><p>Great article, thanks for writing it.</p></div>
<div class="comment"><p>I do not agree with the analysts at all, the rally will last for months.</p></div></section>
</body></html>""",
    """<html><body><div id="menu"><a href="/">Start</a> | <a href="/shop">Shop</a> | <a href="/help">Help</a></div>
<div data-label="main"><p>The recipe needs three eggs, a cup of flour and a little salt, mixed until smooth.</p>
<p>Bake the dough for twenty minutes in a hot oven, then let it rest before you cut it.</p>
<p>Serve warm.</p></div>
<form action="/subscribe"><p>Get our newsletter every week in your inbox.</p><input type="text"><button>Sign up</button></form>
<div class="sidebar"><p>Popular: <a href="/x">Bread</a>, <a href="/y">Cake</a>, <a href="/z">Soup</a></p></div>
<div class="footer">Copyright 2024 Kitchen Site. All rights reserved.</div></body></html>""",
    """<html><body><div class="page"><div class="links"><a href="/1">One</a> <a href="/2">Two</a> <a href="/3">Three</a>
<a href="/4">Four</a> <a href="/5">Five</a></div>
<div data-label="main"><p>Stars form inside clouds of gas and dust that collapse under their own weight over millions of years.</p>
<p>When the core grows hot enough, hydrogen starts to fuse into helium and the young star begins to shine.</p>
<p>Most stars spend the greater part of their lives in this stable phase, burning fuel at a steady rate.</p></div>
<div class="notice">This page was last edited on 3 May.</div>
<div><a href="/prev">Previous</a> <a href="/next">Next</a></div></div></body></html>""",
    """<html><body><main data-label="main"><h1>Notes on gardening</h1><p>Water young plants in the morning.</p>
<p>Mulch keeps the soil moist and stops weeds from growing between the rows of vegetables in summer.</p>
<p><a href="/tools">Tools we use</a></p><div class="share" data-label="other"><a href="/fb">Share</a> <a href="/tw">Post</a></div>
<div class="advert" data-label="other">Garden centre sale this weekend.</div></main>
<footer><p>Contact us at the address below.</p></footer></body></html>""",
    """<html><body><div class="top">Welcome to the travel pages</div>
<article data-label="main"><h2>A week by the sea</h2>
<p>We took the early train to the coast and walked along the cliffs for most of the first day.</p>
<p>In the evening the harbour filled with small boats coming back with the day's catch.</p>
<div class="ad-slot" data-label="other">Cheap flights to the sun, book now.</div>
<p>The last morning was grey, but the walk back to the station was still lovely.</p>
<div id="comments" data-label="other"><p>Lovely story, we went there last year as well and loved it.</p>
<p>Which hotel did you stay in?</p></div></article>
<div class="bottom"><a href="/top">Back to top</a></div></body></html>""",
    """<html><body><article data-label="main"><h1>Seven ways to save water at home</h1>
<p>Fix dripping taps.</p><p>Take shorter showers and turn the tap off while you brush your teeth.</p>
<p>Collect rain in a barrel for the garden and water plants in the cool of the evening.</p></article>
<div class="wrap"><p>Posted by the editors in Home and Living.</p><p>Skip to the top of the page</p></div>
<div class="tags"><a href="/t/water">water</a> <a href="/t/home">home</a></div></body></html>""",
    """<html><body><div data-label="main"><p>A plain page of notes kept by hand, with one long paragraph and no
markup around it at all, which is how many old pages and simple exports look when they are fetched today.</p></div></body></html>""",
    """<html><body><div>Site of the town library</div><div><a href="/hours">Opening hours</a></div>
<div data-label="main"><p>The library will close early on Friday, as the staff move the old books into the new
wing that opened last month on the north side of the square.</p><p>Returns can be left in the box by the door
during the move, and no fines will be charged for the week.</p></div></body></html>""",
]

# Split settings of the tree; small, as the labelled table is small.
TREE_DEPTH = 4
TREE_SEED = 7
# Blocks a leaf holds at least, so that no split serves one labelled block.
LEAF_BLOCKS = 4


def _labelled_blocks(spark: SparkSession) -> DataFrame:
    rows = [block for page in LABELLED_PAGES for block in blocks_of(page)]
    return spark.createDataFrame(rows, BLOCK_SCHEMA.removeprefix("array<").removesuffix(">"))


def train_tree(spark: SparkSession):
    """The decision tree fitted on the blocks of the labelled pages."""
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(_labelled_blocks(spark))
    tree = DecisionTreeClassifier(
        maxDepth=TREE_DEPTH, minInstancesPerNode=LEAF_BLOCKS, seed=TREE_SEED, labelCol="label", featuresCol="features"
    )
    return tree.fit(table)


def tree_column(model, block: Column) -> Column:
    """The fitted tree as one boolean expression over a block's fields: true
    where it predicts main text."""

    def walk(node) -> Column:
        if node.getClass().getSimpleName() == "LeafNode":
            return F.lit(node.prediction() >= 0.5)
        split = node.split()
        feature = block[FEATURES[split.featureIndex()]]
        if split.getClass().getSimpleName() == "ContinuousSplit":
            left = feature <= F.lit(split.threshold())
        else:
            left = feature.isin(*list(split.leftCategories()))
        return F.when(left, walk(node.leftChild())).otherwise(walk(node.rightChild()))

    return walk(model._java_obj.rootNode())


def extract_main_text(pages: DataFrame, keys: list[str], html_col: str = "html", model=None) -> DataFrame:
    """(keys..., text, n_chars): main text of every page, its blocks joined by
    one space, and its code points."""
    model = model or train_tree(pages.sparkSession)
    blocks = page_blocks(pages, keys, html_col)
    kept = F.filter("blocks", lambda b: tree_column(model, b))
    text = F.coalesce(F.array_join(F.transform(kept, lambda b: b["text"]), " "), F.lit(""))
    return blocks.select(*keys, text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
