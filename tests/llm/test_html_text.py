import html
import re
import time

import pytest

from ledgerlake.llm.html_text import Page, container_scores, extract, main_text, winning_paths

PAGES = "page_id long, url string, html string, host string, path string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)


def test_articles_match_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    got = extract(pages).collect()
    assert len(got) == len(source)
    for r in got:
        article = re.search("<article>(.*?)</article>", source[r.page_id], re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain &lt; &amp; t&eacute;xt  here", "plain < & téxt here"),
        ("<p>a</p><!-- open", "a"),
        ('<a href="x>q</a> tail', "q tail"),
        ("<body><p>one<p>two<ul><li>x<li>y</ul></body>", "one\n\ntwo\n\nx\n\ny"),
        ("<body><div class='top-menu'>m</div><main><h2>T</h2>a<b>b</b><br>c<script>1<2</script></main><footer>f</footer></body>", "T\n\nab c"),
        ("<article><p>keep</p><div class=comments><p>no</p></div><aside>no</aside><form>no</form></article>", "keep"),
        ("<nav>only menus</nav>", ""),
        ("<article><p>" + "w " * 50000 + "</p></article>", ("w " * 50000).strip()),
        ("<" * 2000 + "<div" * 500, "<" * 2000),
    ],
)
def test_pages(page, text):
    assert main_text(page, None)[0] == text


def test_hosts_agree_on_a_path(spark):
    """One page's noise outweighs its article; the host's other pages outvote it."""
    usual = "<body><div class='post-{0}'><p>{1}</p></div><div class='x'><p>few</p></div></body>"
    rows = [(i, f"https://Site.org:80/{i}", usual.format(i, "words " * 60)) for i in range(5)]
    odd = usual.format(9, "short text").replace("few", "noise " * 200)
    rows += [(9, "http://site.org/9", odd), (10, None, odd), (11, "http://other.org", None), (11, "http://other.org", "")]
    pages = pages_of(spark, rows)
    got = extract(pages).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[9].path == "/body/div.post-#" and by[9].text == "short text" and by[9].host == "site.org"
    assert by[10].text.startswith("noise") or "noise" in by[10].text
    assert (by[11].text, by[11].n_chars) == ("", 0)
    assert extract(pages_of(spark, [])).collect() == []


def test_nested_article_beats_the_body():
    scores = container_scores("<body><div><article><p>long text here</p></article></div><p>tail</p></body>")
    assert max(scores, key=scores.get) == "/body/div/article"
    assert winning_paths is not None


@pytest.mark.parametrize("words", [20, 2000])
@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<body><div class=post><h1>Head</h1><div class=body><p>{0}</p></div></div></body>", "Head\n\n{0}"),
        ("<body><div class=post><div class=lead>Lead</div><div class=body><p>{0}</p></div></div><div><a href=x>more links</a></div></body>", "Lead\n\n{0}"),
        ("<body><h1>Head</h1><div class=body><p>{0}</p></div></body>", "Head\n\n{0}"),
        ("<body><main><h1>Head</h1><article><p>{0}</p></article></main></body>", "Head\n\n{0}"),
        ("<body><div><div class=body><p>{0}</p></div><div><a href=x>one</a> <a href=y>two</a></div></div></body>", "{0}"),
        ("<body><div><article><p>{0}</p></article><div><p>other</p></div></div></body>", "{0}"),
    ],
)
def test_headlines_stay_with_short_and_long_bodies(spark, page, text, words):
    body = " ".join(["word"] * words)
    assert main_text(page.format(body), None)[0] == text.format(body)
    assert extract(pages_of(spark, [(1, "http://a.org/1", page.format(body))])).first().text == text.format(body)


@pytest.mark.parametrize(
    "names",
    ["class='content has-sidebar'", "id='main' class='layout-no-sidebar'", "class='elementor-widget post-text'", "class='post with-comments'", "class='widget'", "class='menu-open'"],
)
@pytest.mark.parametrize("tag", ["div", "article"])
def test_wrappers_with_marked_words_keep_their_text(tag, names):
    page = f"<body><div class='site-menu'>Home</div><{tag} {names}><p>{'word ' * 40}</p><div class='comment-list'>c</div></{tag}><div id=sidebar>s</div></body>"
    assert main_text(page, None)[0] == ("word " * 40).strip()


def test_long_comments_stay_out():
    page = f"<body><div class=post><p>{'word ' * 40}</p></div><div id=comments><p>{'reply ' * 100}</p></div></body>"
    assert main_text(page, None)[0] == ("word " * 40).strip()


ARTICLE = "<h1>Head line</h1><p>First words of the article, and some more.</p><p>Second part of it.</p>"


@pytest.mark.parametrize("n", [4, 400])
@pytest.mark.parametrize("name", ["comment-list", "post-comments", "disqus_thread", "user-comments-area"])
@pytest.mark.parametrize("layout", ["<article>{a}</article>{c}", "<article>{a}{c}</article>", "<div class='post'>{a}{c}</div>", "<main>{a}{c}</main>", "<div class='post'>{a}</div>{c}"])
def test_comments_are_no_article_however_many(n, name, layout):
    comments = f"<div class='{name}'>" + "".join(f"<div><p>Reader {i} says that this is quite a long remark on it.</p></div>" for i in range(n)) + "</div>"
    page = f"<html><body><div class='menu'><a href='/'>Home</a></div>{layout.format(a=ARTICLE, c=comments)}</body></html>"
    assert main_text(page, None)[0] == "Head line\n\nFirst words of the article, and some more.\n\nSecond part of it."


@pytest.mark.parametrize("name", ["user-comments-area", "site-sidebar-left", "js-ad-slot", "main-cookie-bar", "legal-notice-box"])
def test_any_whole_marked_word_of_a_name_counts(name):
    page = f"<body><article>{ARTICLE}<div class='{name}'><p>Nothing of the article here.</p></div></article></body>"
    assert "Nothing" not in main_text(page, None)[0] and "Second part" in main_text(page, None)[0]


@pytest.mark.parametrize("wrapper", ["<div class='content has-sidebar'>", "<article class='post with-comments'>", "<div id='main' class='layout-no-sidebar'>",
                                     "<div class='elementor-widget post-text'>", "<div class='widget post-text'>", "<div class='post comments-open'>"])
def test_marked_wrappers_of_the_article_stay(wrapper):
    page = f"<body><div class='sidebar'><p>Aside.</p></div>{wrapper}{ARTICLE}</{wrapper[1:].split()[0]}></body>"
    assert main_text(page, None)[0].startswith("Head line") and "Aside" not in main_text(page, None)[0]


@pytest.mark.parametrize("page", ["<div class='a1'>" * 20000 + "deep text", "<div><p>x</p>" * 20000, "<p>it's <b <i ' " * 350000, "<a title=\"x <b \" " * 200000, "<b>" * 100000 + "<div>t" * 1000])
def test_deep_and_broken_pages_take_linear_time(page):
    began = time.process_time()
    Page(page).best()
    main_text(page, None)
    assert time.process_time() - began < 20


def test_quoted_signs_in_attributes():
    page = "<body><article><p title=\"a < b > c\" data-x='<i>'>Plain words.</p></article></body>"
    assert main_text(page, None)[0] == "Plain words."
