"""Column functions and rule-based segmenters against hand-made cases."""

import pytest
from pyspark.sql import functions as F

from glossa.functions import dates, html, lid, segment, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("paragraph", "kept"),
    [("A line.", True), ("  ", False), ("", False), ("Embedded", False), ("an Embed", True), ("  No media  source\ncurrently available now", False), ("share this", False), ("Share this", True), ("0:00", False), ("- Clique para ouvir", False), (" Log in", False)],
)
def test_is_text(spark, paragraph, kept):
    assert one(spark, text.is_text(F.lit(paragraph))) == kept == html.valid(paragraph)


def test_strip_is_pythons(spark):
    for x in ("　 a b \xa0", "\x1c a ", "a", "  ", "​a"):
        assert one(spark, text.strip(F.lit(x))) == x.strip()
        assert one(spark, text.collapse(F.lit(x))) == " ".join(x.split())


def test_urls_and_names(spark):
    parts = one(spark, text.url_parts(F.lit("https://www.abc.example.gov/a/b%20c.html")))
    assert (parts.domain, parts.filename) == ("abc_example", "a_b c")
    assert one(spark, text.url_parts(F.lit("https://a.example.com/x.com/y"))) is None
    assert one(spark, text.unquote(F.lit("a+b%2Fc"))) == "a+b/c" and one(spark, text.unquote(F.lit("bad%zz"))) == "bad%zz"
    assert one(spark, text.sanitize_url(F.lit("https://www.x.y/a?b=c,d  e"))) == "x.y_a_b_c_d_e"
    assert one(spark, text.sanitize_url(F.lit("http://x/y"))) == "http:__x_y"
    assert one(spark, text.domain_outpath(F.lit("http://www.site.example/news/"))) == "site.example_news.json"
    assert one(spark, text.with_suffix(F.lit("a.b.json"), ".txt")) == "a.b.txt"
    assert one(spark, text.html_to_txt(F.lit("a.html.x"))) == "a.x.txt"
    assert one(spark, text.iso_of_section(F.lit("eng_site"))) == "eng" and one(spark, text.iso_of_section(F.lit("eng"))) is None
    assert one(spark, text.capitalize(F.lit("404 ERROR page"))) == "404 error page" and one(spark, text.capitalize(F.lit("aRTICLE"))) == "Article"


def test_page_metadata(spark):
    page = F.lit('<title>T | K</title><script type="text/javascript">var utag_data = {byline: \'A, B\', "k": "v",};</script><script type="application/ld+json"> </script><script type="application/ld+json">{"a": 1}</script>')
    assert one(spark, text.utag_map(page)) == {"byline": "A, B", "k": "v"}
    assert one(spark, text.utag_map(F.lit("nothing"))) == {}
    assert one(spark, text.ld_json(page)) == '{"a": 1}' and one(spark, text.title_of(page)) == "T | K"
    names = text.authors_of(F.lit(None).cast("array<string>"), F.lit(""), F.lit("A , B"), F.array(F.lit("C")))
    assert one(spark, names) == ["A", "B"]
    assert one(spark, html.last_link_of_class(F.lit('<a class="w" href="1">x</a><a class=\'w z\' href=\'2\'>'), "w")) == "2"
    assert one(spark, html.last_link_of_class(F.lit('<a class="ww" href="1">x</a>'), "w")) is None
    assert one(spark, text.title_of(F.lit("<title>A &amp; B &#x27;&eacute;</title>"))) == "A & B 'é"
    assert one(spark, text.without_image_marks(F.lit("a<!-- IMAGE -->b<!--IMAGE--c"))) == "abc"


def test_authors_allowed(spark):
    rule = lambda b, a, n: one(spark, text.author_allowed(F.lit(b).cast("string"), F.lit(a).cast("array<string>") if a is None else F.array(*map(F.lit, a)), F.lit(n)))
    assert rule("By AP staff", None, 1) is False and rule("By AP staff", None, 0) is True
    assert rule(None, ["Reuters"], 3) is False and rule(None, None, 3) is True and rule("apply", ["x"], 3) is True
    assert one(spark, text.title_allowed(F.lit("AP News"))) is False and one(spark, text.title_allowed(F.lit("APnews"))) is True


def test_rendering(spark):
    pars = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    assert one(spark, text.rendered("paragraphs", pars, title=F.lit("T"), authors=F.array(F.lit("x"), F.lit("y")), limit=2)) == "T\nx\ny\n\na\n\nb\n\n"
    sents = F.from_json(F.lit('[["a b","c"],["d"]]'), "array<array<string>>")
    assert one(spark, text.rendered("sentences", sents)) == "a b\nc\n\nd\n\n"
    assert one(spark, text.rendered("sentences", sents, limit=2)) == "a b\nc\n"
    assert one(spark, text.rendered("tokens", F.from_json(F.lit('[[["a","b"],["c"]]]'), "array<array<array<string>>>"))) == "a b\nc\n\n"
    with pytest.raises(ValueError):
        text.rendered("tokens", pars, title=F.lit("T"))
    with pytest.raises(ValueError):
        text.rendered("words", pars)


def test_dates(spark):
    stamp = lambda x: str(one(spark, dates.sitemap_timestamp(F.lit(x).cast("string"))))
    assert stamp("2021-03-05T10:20:30.123456789Z").startswith("2021-03-05 10:20:30.123456") and stamp("None") == "None" and stamp(None) == "None"
    day = lambda *p: one(spark, dates.utag_date(*[F.lit(x).cast("string") for x in p]))
    assert day("2016", "03", "15", "10", "05") == "2016-03-15T10:05:00" and day("2015", "02", "29", None, None) == "2015-02-01T00:00:00"
    assert day("2016", "03", "", None, None) is None
    assert str(one(spark, dates.retrieved(F.lit("05-Mar-2021 (10:20:30.123456)")))) == "2021-03-05 10:20:30.123456"
    assert str(one(spark, dates.archive_time(F.lit("20210305102030")))) == "2021-03-05 10:20:00"
    assert one(spark, dates.year_of(F.lit("1999-01-01"))) == 1999 and one(spark, dates.year_of(F.lit("x"))) is None


def test_roman_segmenter():
    assert segment.segment_roman("Waxaa la sheegay maanta. Haddana waa run! Maxay tahay? Waa wax.") == ["Waxaa la sheegay maanta.", "Haddana waa run!", "Maxay tahay?", "Waa wax."]
    assert segment.segment_roman("Dr. Ali wuxuu yiri sidaas. waa yar.") == ["Dr. Ali wuxuu yiri sidaas. waa yar."]
    assert segment.segment_roman("Sanadkii ahaa 2019. Kadib wuu tegay. Qof 15. Wax") == ["Sanadkii ahaa 2019.", "Kadib wuu tegay.", "Qof 15. Wax"]
    assert segment.segment_roman('He said so "indeed." Then left the place.') == ['He said so "indeed."', "Then left the place."]
    assert segment.segment_roman("uMnu. Moyo wahamba ekuseni. Kwaba njalo") == ["uMnu. Moyo wahamba ekuseni.", "Kwaba njalo"]
    assert segment.segment_roman("Joined here.Again we split it") == ["Joined here.", "Again we split it"]
    assert segment.segment_roman("") == [] and segment.segment_roman("  . ") == ["."]


def test_tibetan_segmenter():
    shad = "།"
    assert segment.segment_tibetan("ཀཁགངཅཆཇ" + shad + "ཉཏཐདནཔཕ" + shad) == ["ཀཁགངཅཆཇ" + shad, "ཉཏཐདནཔཕ" + shad]
    assert segment.segment_tibetan("ཀཁ" + shad + "གངཅཆཇཉཏ" + shad) == ["ཀཁ" + shad + "གངཅཆཇཉཏ" + shad]
    assert segment.segment_tibetan("ཀཁགངཅཆཇཉ" + shad + shad + "ཏཐ") == ["ཀཁགངཅཆཇཉ" + shad + shad, "ཏཐ"]
    assert segment.segment_tibetan("ཀཁགངཅཆཇ༡" + shad + "ཏཐ") == ["ཀཁགངཅཆཇ༡" + shad + "ཏཐ"]


def test_plug_ins(spark):
    segment.register_segmenter("xyz", lambda t: t.split("|"))
    docs = spark.createDataFrame([("xyz", ["a|b", ""]), ("eng", ["One. Two"]), ("zzz", None)], "site_language string, paragraphs array<string>")
    got = {r.site_language: (r.sentences, r.tokens) for r in segment.with_sentences(docs, tokens=True).collect()}
    assert got == {"xyz": ([["a", "b"]], [[["a"], ["b"]]]), "eng": ([["One.", "Two"]], [[["One", "."], ["Two"]]]), "zzz": (None, None)}
    assert {r.site_language: r.sentences for r in segment.with_sentences(docs, supported=("eng",)).collect()}["xyz"] is None


def predictions(**shares):
    entries = [F.struct(F.lit(k), F.struct(F.lit(p).alias("probability"), F.lit(q).alias("proportion"))) for k, (p, q) in shares.items()]
    return F.map_from_entries(F.array(*entries)) if entries else F.create_map().cast("map<string,struct<probability:double,proportion:double>>")


def test_language_rules(spark):
    predict = lambda iso, **p: one(spark, lid.predicted_language(F.lit(iso), predictions(**p)))
    assert predict("som") == "som" and predict("som", eng=(0.5, 0.5)) == "eng" and predict("eng", eng=(0.9, 0.9)) == "eng"
    assert predict("som", eng=(0.95, 0.3), som=(0.91, 0.6)) == "mul" and predict("som", eng=(0.95, 0.03), som=(0.91, 0.6)) == "som"
    assert one(spark, lid.confident_single(predictions(eng=(0.95, 0.95), fra=(0.2, 0.1)))) == "eng" and one(spark, lid.confident_single(predictions(eng=(0.9, 0.95)))) is None
    english = lambda iso, **p: one(spark, lid.english_paragraph(F.lit(iso), predictions(**p)))
    assert english("som", eng=(0.71, 0.26), som=(0.9, 0.7)) and not english("som", eng=(0.7, 0.26), som=(0.9, 0.7)) and english("som", eng=(0.1, 0.1)) and not english("eng", eng=(0.9, 0.9))
    assert one(spark, lid.top_language(predictions(spa=(0.5, 0.5), fra=(0.5, 0.5)))) == "fra"
    assert one(spark, lid.is_unexpected(F.lit("fra"), F.lit("fr"))) is False and one(spark, lid.is_unexpected(F.lit("fra"), F.lit("ru"))) is True and one(spark, lid.is_unexpected(F.lit("bod"), F.lit("fr"))) is None


NEWS = """<html><head><title>T</title><meta name="Author" content="A, B"><meta name="keywords" content="k1, k2"><link rel="canonical" href="http://c/"></head><body>
<div class="intro"><p>Intro <b>bold</b> text
second</p><p>Embed</p></div>
<div id="article-content"><div class="comments"><p>reader</p></div><span class="dateline"> PLACE </span>
<p>First part <a href="x">link</a>and rest<br>after break<!-- c --></p><p>share</p><p>In<!-- IMAGE -->side &lt;!-- IMAGE --&gt;x</p></div>
<div class="article__content"><p>Newer
body</p></div></body></html>"""


def test_news_paragraphs():
    got = html.news_paragraphs(html.tree(NEWS), "eng")
    assert got == ["Intro bold text", "second", "PLACE", "First part and rest", "after break", "Inside x", "Newerbody"]
    assert "First partlinkand restafter break" in html.news_paragraphs(html.tree(NEWS), "sna")
    assert html.news_paragraphs(html.tree('<div id="article-content"><div class="wsw">One<br>Two <i>x</i></div></div>'), None) == ["One", "Two"]


def test_generic_paragraphs_and_metadata(spark):
    page = "<article><h1>Head</h1><p><b>Lead<br><p>Body <i>it</i>alic</p></article><p>out</p>"
    assert html.generic_paragraphs(html.tree(page)) == ["Head", "Lead", "Body italic"]
    frame = spark.createDataFrame([(1, NEWS), (2, None)], "page_id int, html string")
    meta = {r.page_id: r.meta for r in html.with_metadata(frame).collect()}
    assert meta[2] is None and meta[1].authors == ["A, B"] and meta[1].canonical_link == "http://c/" and meta[1].keywords == ["k1", "k2"] and meta[1].has_ptags
    assert {r.page_id: r.paragraphs for r in html.with_paragraphs(frame, profile="news_site").collect()}[2] is None


def test_deep_and_unclosed_markup():
    page = "<article><p>" + "<b>" * 5000 + "deep" + "</i>" * 5000 + "</article><article><p>next</p></article>"
    assert html.generic_paragraphs(html.tree(page)) == ["deep", "next"]


def test_malformed_escapes_stay(spark):
    urls = ["a%2Fb", "100%", "%zz%41", "x+y%20z", "%E4%BD%A0%"]
    got = [r.u for r in spark.createDataFrame([(u,) for u in urls], "u string").select(text.unquote(F.col("u")).alias("u")).collect()]
    assert got == ["a/b", "100%", "%zzA", "x+y z", "你%"]


def test_scripts_with_marks_of_their_own():
    of = segment.segmenter_for
    assert of("amh")("ሰላም ነው። እንዴት ነህ፧ ደህና!") == ["ሰላም ነው።", "እንዴት ነህ፧", "ደህና!"]
    assert of("cmn")("他来了。“好吗？”她问。完") == ["他来了。", "“好吗？”", "她问。", "完"]
    assert of("urd")("یہ ٹھیک ہے۔ کیا؟ ہاں 3.5 ہے") == ["یہ ٹھیک ہے۔", "کیا؟", "ہاں 3.5 ہے"]
    assert of("ell")("Τι είναι; Είναι 3.5 ευρώ. Ναι") == ["Τι είναι;", "Είναι 3.5 ευρώ.", "Ναι"]
    assert segment.tokenizer_for("bod")("བོད་ཡིག། ") == ["བོད་", "ཡིག", "།"]
    assert segment.tokenizer_for("tir")("ሰላም፡ነው። x") == ["ሰላም", "ነው", "።", "x"]
    assert segment.tokenizer_for("cmn")("他 came。") == ["他", "came", "。"]


def test_plain_tags_are_read_as_the_parser_reads_them(monkeypatch):
    """Start tags in their plainest spelling take a shorter way to the same tree, and metadata walk it once."""
    import random

    def shown(n):
        return n if isinstance(n, str) else (n.name, n.attributes, [shown(c) for c in n.children])

    rng = random.Random(0)
    bits = ["<p>", "</p>", '<p class="a b">', '<a href="x&amp;y">', '<a href="x y">t</a>', "<br>", "<br/>", '<meta name="n" content="">', "<P>", "<p x>", '<p x="1" x="2">', '<p  x="1">', "<script>", "</script>", "<title>", "</title>", '<style a="b">', "</style>", "<textarea>", "</textarea>", "<noscript>", '<p x="a', "<x-y>", "<", ">", "&lt;", "text", "<!-- c -->", '<p x="<">', "<plaintext>", '<svg viewbox="0">', "<p >", '<p a="1"b="2">', '<p a="\n">']
    pages = ["".join(rng.choice(bits[:-10] if rng.random() < 0.8 else bits) for _ in range(rng.randint(1, 14))) for _ in range(4000)]
    fast = [shown(html.tree(p)) for p in pages]
    walks = []
    walk = html.Node.walk
    monkeypatch.setattr(html.Node, "walk", lambda self: walks.append(self.name) or walk(self))
    html.metadata(html.tree('<meta name="title" content="t"><p>x</p>'))
    assert walks.count("") == 1
    monkeypatch.delattr(html._Builder, "parse_starttag")
    assert fast == [shown(html.tree(p)) for p in pages]
