"""Main text: markup, boilerplate, templates of a host, odd pages."""

import pytest

from commutewell.llm import templates

PAGES = "page_id long, url string, html string, host string, page int, hash int, templates string"


def extract(spark, pages):
    rows = spark.createDataFrame([(i, url, html, "h", 1, 2, "t") for i, (url, html) in enumerate(pages)], PAGES)
    return {r.page_id: r.text for r in templates.main_texts(rows).collect()}


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<p>a  b\n c</p><p>d</p>", "a b c\nd"),
        ("<p>open<p>next<div>in</div>out", "open\nnext\nin\nout"),
        ("<b>bold<br>text</b> on", "bold text on"),
        ("a &amp; b &lt;c&gt; &eacute;&#233;&#xe9; &nbsp; d", "a & b <c> ééé d"),
        ("<nav>menu</nav><article><h1>T</h1><p>x <i>y</i>z</p></article><footer>f</footer>", "T\nx yz"),
        ("<main><aside>no</aside><p>yes</p><form><input>no</form></main>after", "yes"),
        ("<article><header><h1>Title</h1></header><p>x</p><div class='comments'><p>no</p></div></article>", "Title\nx"),
        ("<header>no</header><p>yes</p><div id=cookie-notice>no</div><div role='navigation'>no</div>", "yes"),
        ("<script>var t='</p><p>no';</script><style>p{}</style><!-- no <p>no</p> --><p>yes", "yes"),
        ("<p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a\nb\nc\nd\ne"),
        ("1 < 2 and <> </> <p title='a>b'>yes", "1 < 2 and <> </>\nyes"),
        ("<p>x</b></i>y</p></div></section>z", "xy\nz"),
        ("<div class='shadow header-less'><p>kept</p></div><div class='adv'>no</div>", "kept"),
        ("<p title='a<b' class=\"x > y\">yes<img alt=\"<p>no\"/> more</p>", "yes more"),
        ("<p class=\"open>text</p><p>yes</p>", "text\nyes"),
        ("", ""),
        (None, ""),
    ],
)
def test_markup(html, want):
    assert templates.text_of(templates.parse(html), set()) == want


def test_site_templates_go_and_articles_stay(spark):
    site = "<div><span>Our house</span> <a href=/>home</a></div>"
    pages = [(f"https://a.example/{i}", f"<body>{site}<div><p>story {i}</p></div></body>") for i in range(40)]
    pages += [(f"https://b.example/{i}", f"<body><div>other {i}</div>{site if i == 1 else ''}</body>") for i in range(20)]
    got = extract(spark, pages)
    assert all(got[i] == f"story {i}" for i in range(40))
    assert got[41] == "other 1\nOur house home"


def test_copies_of_an_article_are_no_template(spark):
    pages = [(f"https://a.example/{i}", f"<body><article><div><p>same</p></div><p>shared</p></article><i>{i}</i></body>") for i in range(50)]
    pages += [(f"https://a.example/x{i}", f"<body><article><p>shared</p><div>more like this</div><p>own {i}</p></article></body>") for i in range(50)]
    got = extract(spark, pages)
    assert got[0] == "same\nshared" and got[50] == "shared\nown 0"


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</i>" * 3000
    pages = [(None, None), (None, "<p>x"), ("not an address", "<p>y"), ("https://a.example", ""), ("https://a.example", "<" * 2000), (None, deep)]
    got = extract(spark, pages + pages[:2])
    assert [got[i] for i in range(8)] == ["", "x", "y", "", "<" * 2000, "deep", "", "x"]
    empty = spark.createDataFrame([], PAGES)
    assert templates.main_texts(empty).count() == 0


def test_hosts(spark):
    urls = ["https://A.example:80/x", "http://u:p@a.example?q", "//none", None, "ftp://b.example#f"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in rows.select(templates.host_of(rows.url)).collect()] == ["a.example", "a.example", "?//none", "?", "b.example"]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<div class='content has-sidebar'><article><p>x y</p></article></div><div class=sidebar>no</div>", "x y"),
        ("<div class='page with-comments'><article><p>x y</p></article></div>", "x y"),
        ("<article class='post comments-open'><p>x y</p><div class=comments><p>no no no no</p></div></article>", "x y"),
        ("<div class='layout sidebar'><main><p>x y</p></main></div><div class=menu><p>no</p></div>", "x y"),
        ("<div class='wrap search'><div class=widget><article><p>x y</p></article></div></div>", "x y"),
        ("<div class='page sidebar'><h1>Title</h1><p>the text of the page</p></div><div class=ad><p>no</p></div>", "Title\nthe text of the page"),
        ("<article><p>x</p></article><div class='related posts'><article><p>no no no</p></article></div>", "x"),
        ("<p>short</p><div class=comments><p>longer than it</p></div>", "short"),
    ],
)
def test_marks_on_wrappers(html, want):
    assert templates.text_of(templates.parse(html), set()) == want


@pytest.mark.parametrize(
    ("box", "kept"),
    [
        ("<div class='share-prices'><p>Prices rose by a tenth.</p></div>", True),
        ("<section class='related-work'><h2>Earlier</h2><p>Others have tried it before us.</p></section>", True),
        ("<div class='alert'><p>Do not open the lid while it runs.</p></div>", True),
        ("<blockquote class='reply'>We have nothing to say about it, he wrote.</blockquote>", True),
        ("<div class='menu-costs'>The set meal <b>costs ten</b> francs now.</div>", True),
        ("<div class='share-prices'><a href=/x>Read what the prices did last week.</a></div>", False),
        ("<div class='share-buttons'><p>Tell your friends about this page.</p></div>", False),
        ("<div class='related-posts'><p>Another one that you may like too.</p></div>", False),
        ("<div class='promo'><p>Buy one of our books this week.</p></div>", False),
        ("<div class='newsletter-box x2'><p>Our letter comes on every Monday.</p></div>", False),
        ("<section class='comments'><div class='reply'><p>I do not believe a word of it.</p></div></section>", False),
        ("<div class='cookie-notice'><p>We use cookies on all our pages.</p></div>", False),
        ("<div class='ad-slot'><p>Buy one of our books this week.</p></div>", False),
        ("<div class='alert'>Careful</div>", False),
    ],
)
def test_marks_inside_articles(box, kept):
    for tag in ("article", "main"):
        html = f"<{tag}><p>The first words of it.</p>{box}<p>The last words of it.</p></{tag}>"
        text = templates.text_of(templates.parse(html), set())
        assert (text.count("\n") >= 2) == kept
    outside = f"<article><p>The first words of it.</p></article>{box}"
    assert templates.text_of(templates.parse(outside), set()) == "The first words of it."


def test_marked_boxes_with_sentences_go_where_they_recur(spark):
    box = "<div class='alert'><p>Our shop is closed all week.</p></div>"
    pages = [f"<article><p>The words of number {i} are here.</p>{box if i < 12 else ''}</article>" for i in range(20)]
    got = extract(spark, [(f"https://a.example/{i}", p) for i, p in enumerate(pages)])
    assert all(got[i] == f"The words of number {i} are here." for i in range(20))


STORY = "A story of some length that many pages of the site hold again, word by word."


@pytest.mark.parametrize("story", [f"<p>{STORY}</p>", STORY, f"<h1>{STORY[:9]}</h1><p>{STORY}</p>"])
def test_copies_without_an_article_element_are_no_template(spark, story):
    pages = [f"<div>No. {i}</div><div>{story}</div><div><a href=/{i}>go to {i}</a></div>" for i in range(30)]
    pages += [f"<div><p>another text, which is the {i}th</p></div><div><b>Our house</b></div>" for i in range(10)]
    got = extract(spark, [(f"https://a.example/{i}", p) for i, p in enumerate(pages)])
    assert all(STORY in got[i] for i in range(30))
    assert got[30] == "another text, which is the 0th"


def test_boxes_go_whatever_the_size_of_the_host(spark):
    """An unmarked box on few pages of a large host, and a box of prose in the same place of every article."""
    box, note = "<div>Our <b>house</b></div>", "<div><h3>About us</h3><p>We are here for you.</p></div>"
    pages = [f"{box if i < 9 else ''}<div><p>text {i}</p></div>" for i in range(400)]
    pages += [f"<article>{'<p>more words of it</p>' * (i % 3)}<p>some words on number {i}</p>{note}</article>" for i in range(12)]
    shared = "<div><p>A passage that articles share.</p></div>"
    pages += [f"<article>{'<p>first</p>' * i}{shared}{'<p>last</p>' * (20 - i)}<p>number {i}</p></article>" for i in range(12)]
    got = extract(spark, [(f"https://a.example/{i}", p) for i, p in enumerate(pages)])
    assert all(got[i] == f"text {i}" for i in range(400))
    assert got[400] == "some words on number 0" and "About us" not in "".join(got[i] for i in range(400, 412))
    assert all("A passage that" in got[i] for i in range(412, 424))
