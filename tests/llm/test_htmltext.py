"""HTML extraction: blocks, tree, whole pages against a plain article cutter, edge cases, long pages."""

import html
import re
import time

import numpy as np
from pyspark.sql import functions as F

from llm_cases import SF_CHECK

from strata.llm import htmltext
from strata.llm.queries import QUERIES


def article(page: str) -> str:
    """Brute force for the synthetic pages: what stands between the article tags."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split())
              for b in re.split(r"</?(?:p|h1|article)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_query_gives_the_articles(spark):
    got = QUERIES["op11_html_extraction"](spark, SF_CHECK)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_CHECK}/pages.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text) == (pages[r.page_id].url, article(pages[r.page_id].html))
        assert r.n_chars == len(r.text)


#: Pages of layouts that the labelled table does not hold, with their main text.
HELD_OUT = [
    ("<body class='has-sidebar'><header><h1>Site</h1><p>Tag line of the site</p></header><div id='cookieBar'>We use cookies.</div>"
     "<main><article><header><h1>T</h1></header><p>One.</p><p>Two <a href='#'>all link</a></p><ul><li>a<li>b</ul><div class='ad-slot'>"
     "<p>buy</p></div><form><input><p>Sub</p></form><p>End &amp; out.&nbsp;x</p></article><section class='comments'><h2>Comments</h2>"
     "<article><p>a long comment of a reader with many words in it, all of them kind</p></article></section></main><aside class='x'>"
     "<p>About us: a text with quite a few words and without any link in it</p></aside><footer>f</footer>",
     "T\nOne.\nTwo all link\na\nb\nEnd & out. x"),
    ("<div class='menu-main'><a>a</a><a>b</a></div><div class='post-content'>abc<script>if (a<b) x='<p>'</script> d<b>e</b>f</div>"
     "<div class='post-comments'><p>yes</p></div>", "abc def"),
    ("<div><a>a</a></div><p>" + "word " * 30 + "</p><p>" + "more " * 9 + "</p><p>" + "text " * 50 + "</p><div><a>x y</a></div>"
     "<div>Copyright 2020</div>", "\n".join([" ".join(["word"] * 30), " ".join(["more"] * 9), " ".join(["text"] * 50)])),
    ("<article><p>1 &lt; 2<!-- <p>no</p> --><p>x<br>y</article><script>never closed <p>no", "1 < 2\nx y"),
    ("<article><p title='a>b'>q</p><p>5 < 6 <> <3</article>", "q\n5 < 6 <> <3"),
]


def test_held_out_layouts():
    tree = htmltext.train()
    for page, text in HELD_OUT:
        assert htmltext.main_text(page, tree) == text


def test_tree_learns_its_table_and_a_rule():
    pages = htmltext.labelled_blocks()
    assert 100 < sum(map(len, pages)) < 200
    tree = htmltext.train()
    for blocks in pages:
        assert [b.label for b in blocks] == list(htmltext.classify(tree, htmltext.features(blocks)))
    rng = np.random.default_rng(1)
    x = rng.random((400, 3))
    y = ((x[:, 1] > 0.3) & (x[:, 2] < 0.7)).astype(float)
    test = rng.random((400, 3))
    assert (htmltext.classify(htmltext.grow(x, y), test) == ((test[:, 1] > 0.3) & (test[:, 2] < 0.7))).mean() > 0.97


def test_features_hold_the_neighbours():
    x = htmltext.features(htmltext.read_blocks("<p>a b</p><p><a>c</a> d e f</p><p>g</p>"))
    at = {n: i for i, n in enumerate(htmltext.FEATURES)}
    assert x[1, at["words"]] == 4 and x[1, at["link density"]] == 0.25
    assert (x[1, at["words before"]], x[1, at["words after"]]) == (2, 1)
    assert (x[0, at["link density after"]], x[2, at["link density before"]]) == (0.25, 0.25)
    assert x[0, at["words before"]] == x[2, at["words after"]] == 0


def test_edges(spark):
    rows = [(1, "u", None), (None, None, ""), (2, "u", " \n"), (3, "u", "<article>x</article>"), (3, "u", "<article>x</article>"),
            (4, "u", "<article>" + "<p>w</p>" * 3000), (5, "u", "<article>😀 é".encode("utf-16", "surrogatepass").decode("utf-16"))]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string").repartition(3)
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in htmltext.extract(pages).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (None, None, "", 0), (2, "u", "", 0), (3, "u", "x", 1), (3, "u", "x", 1),
                          (4, "u", "\n".join("w" * 3000), 5999), (5, "u", "\U0001F600 é", 4)], key=str)
    assert htmltext.extract(pages.limit(0)).count() == 0
    blocks = htmltext.block_table(pages).where("page_id = 4")
    assert blocks.count() == 3000 and blocks.where(F.col("main")).count() == 3000


def test_long_pages_take_linear_time():
    tree = htmltext.train()
    for page in ("<" * 10**6, '<a "' * 200_000, "<!--" * 200_000, "<div>" * 100_000 + "x", "<script>" * 100_000, "<b>" * 100_000 + "<p>" * 100_000,
                 "<a " + '"' * 10**6, "<p>" + " " * 10**6 + "a", "<article>" + "word " * 300_000):
        t = time.process_time()
        htmltext.main_text(page, tree)
        assert time.process_time() - t < 10
