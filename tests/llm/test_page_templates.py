import pytest

from facetforge.llm.page_templates import extract_main_text, host_of, main_text, parse, template_keys


def text_of(html, template=()):
    return main_text(parse(html, ""), set(template))


def test_article_blocks():
    page = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p><p>x";</script></head><body>
      <nav><ul><li><a href="/a">A</a></li></ul></nav><div class="ad">Buy</div><!-- note -->
      <article><h1>Head &amp; line &eacute;&#33;</h1><p><b>One
      two<br>three<p>Four&nbsp;five</p><aside>Side</aside><form>Send</form>
      <div class="comments"><p>A reader</p></div><ul><li>x<li>y</ul></article>
      <footer>&copy; site</footer>"""
    assert text_of(page) == "Head & line é!\nOne two three\nFour five\nx\ny"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain words", "plain words"),
        ("<p>a<div>b</div>c", "a\nb\nc"),
        ("<main><p>in</p></main><p>out</p>", "in"),
        ("<body><header>top</header><p>a</p></body>", "a"),
        ("<article><header><h1>title</h1></header><p>a</p></article>", "title\na"),
        ("<article><p>open", "open"),
        ("</p></div><p>a</b></p>", "a"),
        ("<div hidden>no</div><div style='display: none'>no</div><p>yes", "yes"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\nc"),
        ("<p>x &am y &amp z &quot;q&quot; &notanentity;", 'x &am y & z "q" ¬anentity;'),
        ("<article>a</article><p>b</p><article>c</article>", "a\nc"),
        ("<p>a < b and c > d</p>", "a < b and c > d"),
    ],
)
def test_markup(html, text):
    assert text_of(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<div class='content-sidebar-wrap'><main><p>a</p></main></div>", "a"),
        ("<div class='sidebar'><main><p>a</p></main></div>", "a"),
        ("<div class='has-sidebar'><article><p>a</p></article></div>", "a"),
        ("<article><section id='related-work'><p>a</p></section><p>b</p></article>", "a\nb"),
        ("<article><section id='social-history'><p>a</p></section></article>", "a"),
        ("<article><h2 id='menu-of-the-day'>Soup</h2><p>a</p></article>", "Soup\na"),
        ("<article><div class='cookie-recipe'><p>a</p></div></article>", "a"),
        ("<article><div class='cookie-notice'>no</div><p>a</p></article>", "a"),
        ("<article><ul class='related-posts'><li>no</ul><p id='comment'>no</p><p>a</p></article>", "a"),
        ("<div id='site-footer'>no</div><p>a</p>", "a"),
        ("<article><img class='ad'><p class='ad'>no</p>a</article>", "a"),
    ],
)
def test_names_drop_only_what_they_fully_name(html, text):
    assert text_of(html) == text


def test_deep_nesting_needs_no_recursion():
    assert text_of("<div>" * 30_000 + "deep") == "deep"


def rows(spark, pages):
    return spark.createDataFrame(pages, "page_id long, url string, html string")


def page(i, content):
    return (
        f"<body><div><span>Home of the site</span></div><div>unique {i}</div>{content}"
        "<div>Call us now</div></body>"
    )


def test_recurring_subtrees_of_a_host_go(spark):
    long = "word " * 30
    pages = [(i, "https://a.example.org/x", page(i, f"<p>{long}</p>")) for i in range(4)]
    pages += [(10 + i, "http://user@b.example.org:80/", page(i, "<p>text</p>")) for i in range(2)]
    found = {r["page_id"]: r["text"].split("\n") for r in extract_main_text(rows(spark, pages)).collect()}
    for i in range(4):
        assert found[i] == [f"unique {i}", long.strip()]  # copies of content stay
    for i in range(2):  # two pages make no template
        assert found[10 + i] == ["Home of the site", f"unique {i}", "text", "Call us now"]


def test_menus_inside_an_article_go_but_its_text_stays(spark):
    menu = "<div><a href=1>first link</a> <a href=2>second link</a></div>"
    html = f"<article><p>Short text</p>{menu}<p>See <a href=3>x</a> here</p></article>"
    pages = [(i, "https://a.example.org", html) for i in range(5)]
    assert {r["text"] for r in extract_main_text(rows(spark, pages)).collect()} == {"Short text\nSee x here"}
    assert text_of(html) == "Short text\nfirst link second link\nSee x here"


def test_counts_equal_brute_force(spark):
    pages = [
        (i, f"https://h{i % 3}.example.org/", page(i % 4, f"<p>text {i % 5}</p>")) for i in range(40)
    ]
    counts = {}
    for _, url, html in pages:
        for key in template_keys(parse(html, host_of(url))):
            counts[key] = counts.get(key, 0) + 1
    wanted = {
        i: main_text(parse(h, host_of(u)), {k for k, n in counts.items() if n >= 3}) for i, u, h in pages
    }
    result = extract_main_text(rows(spark, pages)).collect()
    assert {r["page_id"]: r["text"] for r in result} == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in result)


def test_nulls_repeats_and_clashing_names(spark):
    data = [(None, None, None, 1, "x"), (1, None, "<p>a", 1, "x"), (1, "not a url", "<p>a", 1, "x"), (2, "", "", 1, "x")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, TEXT int, `b.c` string")
    result = extract_main_text(pages)
    assert result.columns == ["page_id", "url", "html", "b.c", "text", "n_chars"]
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in result.collect()) == [
        (0, "", 0), (1, "a", 1), (1, "a", 1), (2, "", 0)
    ]
    assert extract_main_text(pages.limit(0)).count() == 0


def test_hosts():
    assert host_of("HTTPS://User:pw@WWW.Example.org:8080/p?q#f") == "www.example.org"
    assert host_of("mailto:x") == host_of(None) == host_of("") == ""
