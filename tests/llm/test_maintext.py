"""Main text of hand-made pages, and of the tables' pages against a plain reading of their article element."""

import html
import re

import pytest

from glossa.llm import maintext as mt
from glossa.llm.queries import op2_main_text

PAGE = "<html><head><title>T</title><script>if (a<b) x('</p>')</script></head><body><nav><ul><li><a href='/a'>Home</a></li></ul></nav><article><h1>Head &amp; line</h1><p><b>One  two<br><p>three &lt; four</p></article><footer>(c)</footer></body></html>"


@pytest.fixture(scope="module")
def weights():
    return mt.Weights(mt.counted(iter([PAGE] * 20)))


def test_best_region_equals_all_ranges():
    import random

    rng = random.Random(1)
    for _ in range(200):
        x = [rng.choice([-3, -1, -0.5, 0, 1, 2]) for _ in range(rng.randint(0, 12))]
        low, high = mt.best_region(x)
        best = max([sum(x[a:b]) for a in range(len(x)) for b in range(a + 1, len(x) + 1)], default=0)
        assert sum(x[low:high]) == max(best, 0)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (PAGE, "Head & line One two three < four"),
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<p>seen</p><!-- open <p>never</p>", "seen"),
        ("<article>a<div class='ad'>buy</div><p>b</p><aside>c</aside><form><input value=1>d</form><p>e<section class='reader-comments'>f</section></article>", "a b e"),
        ("<body class='has-sidebar'><div class='cookie-notice'>yes</div><div><p>main words of the page</p></div><div id='comments'><p>nice</p></div></body>", "main words of the page"),
        ("<header>site</header><main><header><h1>Title</h1></header><p>text&nbsp;here&#33;</p><div role=navigation>x</div></main>", "Title text here!"),
        ("<article><p>in<b>li</b>ne &copy; 3 < 4</article>", "inline © 3 < 4"),
        ("<article><style>p{}</style><noscript>enable</noscript><p title='a > b'>kept</p><textarea>no</textarea></article>", "kept"),
        ("<article class='post'><p>post</p></article><article class='comment'><p>reader</p></article>", "post"),
        ("<article><p>first</p></article><div class='ad'>buy</div><article><p>second</p></article>", "first second"),
        ("<article><p>a</p><section class='social-history'>b</section><div id='related-work'>c</div></article>", "a b c"),
        ("<div class='notice-board-content'><p>all of it</p></div>", "all of it"),
        ("<div class='cookie-notice ad-300x250'>x</div><p>y</p><div class='related-posts'>z</div>", "y"),
        ("<div><p>a</p><div class='entry-footer'>b</div><div class='related-news'>c</div><div id='adSlot3'>d</div><p class='comment-policy-explained'>e</p></div>", "a e"),
        ("<article><p>text</p><ul><li>one</li><li>two</li></ul></article>", "text one two"),
    ],
)
def test_pages(weights, page, text):
    assert mt.main_text(page, weights) == text


def plain(page):
    inner = page[page.index("<article>") : page.index("</article>")]
    return " ".join(html.unescape(re.sub("<[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))).split())


def test_query_equals_plain_reading(spark, sf_dir):
    got = {r.page_id: (r.text, r.n_chars) for r in op2_main_text(spark, sf_dir).collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert got == {p.page_id: (plain(p.html), len(plain(p.html))) for p in pages}


def test_without_article_element_the_region_is_the_same(spark, sf_dir):
    pages = [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    weights = mt.Weights(mt.counted(iter(pages)))
    for p in pages:
        assert mt.main_text(p.replace("<article>", "<div>").replace("</article>", "</div>"), weights) == plain(p)


def test_labels_are_only_read_to_fit():
    """Pages without any of the marks that help: places and words alone part text from the rest."""
    rows = [f"<div><div>Home News Sport Contact Imprint</div><div>Subscribe now for offers</div><article><p>The {k} river rose over night and people left their homes.</p><p>Water stood high in all streets of the old town.</p></article><div>Home News Sport all rights</div></div>" for k in range(60)]
    weights = mt.Weights(mt.counted(iter(rows)))
    for page in rows:
        bare = page.replace("<article>", "<div>").replace("</article>", "</div>")
        want = re.sub("<[^>]*>", " ", page[page.index("<article>") : page.index("</article>")])
        assert mt.main_text(bare, weights) == mt.main_text(page, weights) == " ".join(want.split())


def test_scores_equal_a_plain_version(weights):
    """The region is the best of all ranges of the page's items."""
    for page in (PAGE, "<p>a b</p><table><tr><td>1<td>2</table><a href=x>y z</a><p>c</p>"):
        scores = [weights.score(x) for x in mt.items(page)[0]]
        low, high = mt.best_region(scores)
        assert sum(scores[low:high]) == pytest.approx(max(sum(scores[a:b]) for a in range(len(scores)) for b in range(a, len(scores) + 1)))


def test_long_and_deep_pages_take_linear_time(weights):
    import time

    began = time.perf_counter()
    assert mt.main_text("<div>" * 100_000 + "x" + "</div>" * 100_000, weights) == "x"
    assert mt.main_text("<p>" + "<b>" * 50_000 + "deep" + "<p>next" * 20_000, weights).startswith("deep next")
    assert len(mt.main_text("<p>" + "word " * 1_000_000, weights)) == 4_999_999
    assert time.perf_counter() - began < 15


def test_frames(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 0), (1, "u", PAGE, 0), (None, None, None, 1)], "page_id bigint, url string, html string, id int")
    got = sorted((r.page_id or 0, r.text) for r in mt.extract(pages, mt.fit(pages)).collect())
    assert got == [(0, ""), (1, "Head & line One two three < four"), (1, "Head & line One two three < four")]
    assert mt.extract(pages.limit(0), mt.fit(pages.limit(0))).count() == 0
