import html
import re

import pytest

from terrabrook.llm import html_text as H
from terrabrook.llm import page_blocks as B

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tree(spark):
    return H.fit_tree(spark)


#: Pages that the tree was not fitted on, with their main text.
HELD_OUT = [
    (
        """<html><head><title>T</title><script>if (a<b) document.write("<p>no</p>")</script></head><body><header class="site"><h1>Hill Radio</h1><nav><a href="/">Live</a></nav></header>
<main><article><h1>Goats return to the&nbsp;quarry</h1><p class="byline">By Ann Field</p><p>Six goats &amp; two kids now graze where stone was cut
until 1970 &lt;or so&gt;.</p><p>They<b> like</b> it.</p><div class="ad-slot">Boots, half price until Sunday, in all sizes and three colours.</div>
<blockquote>We had to fence the steep side first.</blockquote><!-- <p>old</p> --><p>Visitors may feed them <a href="/rules">by the rules</a> of the club.</p></article>
<section class="comments-area"><article class="comment"><p>My children love them, we come by every weekend now.</p></article></section></main>
<aside><h2>Latest</h2><p>Snow is forecast for the upper villages by the end of this week.</p></aside><footer><p>Hill Radio, Quarry Lane 1.</p></footer></body></html>""",
        ["Goats return to the quarry", "By Ann Field", "Six goats & two kids now graze where stone was cut until 1970 <or so>.", "They like it.", "We had to fence the steep side first.", "Visitors may feed them by the rules of the club."],
    ),
    (
        """<BODY><DIV ID=navbar><A HREF=/a>Alpha</A> <A HREF=/b>Beta</A></DIV><DIV CLASS='post-content'><H2>Sharpening a plane</H2><P>Hold the iron at thirty degrees and push it over the wet stone in long strokes.
<P>Turn it over.<P>Rub off the burr on leather, and test the edge on the end of a soft board.</DIV>
<DIV CLASS="post-footer">Posted in tools on a Friday by the workshop team.</DIV><TEXTAREA>Type here and say what you think about it.</TEXTAREA></BODY>""",
        ["Sharpening a plane", "Hold the iron at thirty degrees and push it over the wet stone in long strokes.", "Turn it over.", "Rub off the burr on leather, and test the edge on the end of a soft board."],
    ),
    (
        """<html><body><div><a href="1">Front</a> <a href="2">World</a> <a href="3">Money</a></div><h1>Old tram found under the car park</h1>
<p>Workers who were digging for new cables have come upon a whole tram from the nineteen-twenties, with seats and lamps still in place.</p><p>It is now in a hall.</p>
<p>The museum hopes to show it in two years, once the rust has been stopped and the roof is mended.</p><div><a href="4">More from this town</a></div></body></html>""",
        [
            "Old tram found under the car park",
            "Workers who were digging for new cables have come upon a whole tram from the nineteen-twenties, with seats and lamps still in place.",
            "It is now in a hall.",
            "The museum hopes to show it in two years, once the rust has been stopped and the roof is mended.",
        ],
    ),
    (
        """<html><body><div class="gdpr-banner"><p>This site stores small files on your device to remember your choices.</p></div><article class="has-sidebar"><h1>Tide tables</h1><p>High water is at six.</p>
<div class="sidebar"><p>Harbour cameras show the state of the sea at all hours of the day.</p></div><form><p>Report an error in this table to the harbour master.</p></form><p>Low water follows at noon.</p></article>
<div class="social">Follow us wherever you like to read such things.</div>""",
        ["Tide tables", "High water is at six.", "Low water follows at noon."],
    ),
]


@pytest.mark.parametrize("k", range(len(HELD_OUT)))
def test_held_out_pages(tree, k):
    page, want = HELD_OUT[k]
    assert H.main_texts([page], tree) == ["\n".join(want)]


def test_labelled_pages(tree):
    rows = H.labelled_blocks()
    import numpy as np

    found = tree.predict(np.array([f for f, _ in rows]))
    assert sum(f != bool(label) for f, (_, label) in zip(found, rows, strict=True)) <= 0.05 * len(rows)


def brute(page):
    """The article of the given tables' pages by plain string steps: its blocks begin and end at h1, p and article tags."""
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:h1|p)>", re.sub(r"<br>", " ", re.sub(r"</?b>", "", body)))
    return "\n".join(x for p in parts if (x := " ".join(html.unescape(p).split())))


def test_given_pages(spark):
    found = H.op12_html_text(spark, DATA)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    want = {r.page_id: (r.url, brute(r.html)) for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    rows = found.collect()
    assert len(rows) == len(want) and all((r.url, r.text, r.n_chars) == (*want[r.page_id], len(want[r.page_id][1])) for r in rows)


def test_nulls_repeats_and_clashing_names(spark, tmp_path):
    page = HELD_OUT[3][0]
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (None, None, page, None), (2, "v", None, "x"), (3, "w", "", "x"), (4, "z", "<nav>menu</nav>", "x")]
    spark.createDataFrame(rows, "page_id long, url string, html string, text string").write.parquet(f"{tmp_path}/pages.parquet")
    text = "\n".join(HELD_OUT[3][1])
    found = sorted((r.page_id or 0, r.text, r.n_chars) for r in H.op12_html_text(spark, str(tmp_path)).collect())
    assert found == [(0, text, len(text)), (1, text, len(text)), (1, text, len(text)), (2, "", 0), (3, "", 0), (4, "", 0)]
    extracted = H.extract(spark.read.parquet(f"{tmp_path}/pages.parquet"))
    assert extracted.columns == ["row", "text"] and extracted.schema["row"].dataType.names == ["page_id", "url", "text"]
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/none/pages.parquet")
    assert H.op12_html_text(spark, f"{tmp_path}/none").collect() == []


def texts(page):
    return [b.text for b in B.page_blocks(page)]


def test_blocks_of_broken_markup():
    assert texts("a < b and c <- d &lt;e&gt; &#233;&nbsp;&eacute;") == ["a < b and c <- d <e> é é"]
    assert texts("<p title='a > b' data-x=\"</p>\">one<p>two<br>lines\n\t three<hr>four") == ["one", "two lines three", "four"]
    assert texts("<style>x</style><script>'</p><p>no'</SCRIPT >yes<!-- <p>no --><svg><text>no</text></svg><template><p>no</template>") == ["yes"]
    assert texts("end <a href='x") == ["end"] and texts("<script>never closed <p>no") == [] and texts("<!-- never closed <p>no") == []
    assert texts("</div></p>text</section>") == ["text"] and texts("<div/>x<DIV>y</dIV>z") == ["x", "y", "z"]
    assert texts("<li>a<li>b<td>c<td>d") == ["a", "b", "c", "d"]
    assert texts('<p class=a">x</p><p a="b\'>">y</p>') == ["x", "y"]


def test_long_pages_take_linear_time():
    import time

    for part in ("<p a='", "<", "<!--", "<script>", "<div class=", "<button>x", "&#", "<b><i>", "<td", "<a href=\"", "= ", '<p ="'):
        began = time.perf_counter()
        B.page_blocks(part * 100_000)
        assert time.perf_counter() - began < 15, part


def test_deep_pages():
    blocks = B.page_blocks("<div class='ad'>" * 5000 + "deep" + "</div>" * 5000 + "<p>out</p>")
    assert [(b.text, b.chrome > 0) for b in blocks] == [("deep", True), ("out", False)]


def test_very_long_text(tree):
    words = "word " * 400_000
    assert H.main_texts([f"<nav>menu</nav><article><p>{words}</p></article>"], tree) == [words.strip()]
