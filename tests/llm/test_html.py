import pytest

from quillmill.llm import html_wrappers as H

PAGE = '<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="ad">Buy</div>{}<footer>&copy; host</footer>'


def test_article_with_semantic_marks():
    page = PAGE.format("<article><h1>A &amp; B</h1><p><b>one  <i>tw</i>o<br>three<p>four&nbsp;five<!-- no --><aside>side</aside><form>f</form><div class='user-comments'>nice</div><ul><li>x<li>y</ul></article>")
    assert H.text_of(page, ["html", "body", "article"]) == "A & B one two three four five x y"
    assert H.text_of(page, None) == H.text_of(page, ["html", "nowhere"]) == "A & B one two three four five x y"


def test_article_found_by_what_varies():
    pages = [PAGE.format(f'<div id="wrap"><div class="top">Welcome to our site, dear readers, all of you</div><div class="post">{"".join(f"<p>Para {k} {j} says something new.</p>" for j in range(3))}</div></div>') for k in range(4)]
    path = H.region(H.infer(pages))
    assert path[-1] == "div.post" and H.text_of(pages[2], path).startswith("Para 2 0 says") and "Welcome" not in H.text_of(pages[2], path)


def test_wrappers_have_options_groups_and_slots():
    a, b = "<main><h1>x</h1><p>1</p><p>2</p></main>", "<main><h1>y</h1><h2>s</h2><p>3</p></main>"
    assert H.infer([a, b]).notation() == "<> <main> <h1> #text </> <h2> \"s\" </>? <p> #text </>+ </> </>"
    pairs = "<dl>" + "<dt>t</dt><dd>d</dd>" * 3 + "</dl>"
    assert H.infer([pairs]).notation() == '<> <dl> (<dt> "t" </> <dd> "d" </>)+ </> </>'


@pytest.mark.parametrize("page,text", [("", ""), ("plain", "plain"), ("<p>a<p>b", "a b"), ("<nav>m</nav>", ""), ("<div hidden>x</div>y", "y"), ("a < b", "a < b"), ("<article>a&lt;b&#233;&bogus;</article>", "a<bé&bogus;"), ("<article>x<script>if(a<b){}</script>y</article>", "xy"), ("<article>un<em>broken</em></article>", "unbroken"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"), ("<article>cut <b", "cut <b")])
def test_small_pages(page, text):
    assert H.text_of(page, None) == text


def test_deep_and_long_pages():
    deep = "<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "end</article>"
    assert H.text_of(deep, None) == "deep end"
    assert H.text_of("<article>" + "<p>word</p>" * 20_000 + "</article>", None) == " ".join(["word"] * 20_000)
    H.text_of("<div '" * 3000, None)


def test_excluded_elements_below_any_depth_and_long_mixed_lists():
    deep = "<article>" + "<div>" * 300 + "<nav>MENU<div>more<nav>x</nav></div></nav>text" + "</div>" * 300 + "end</article>"
    assert H.text_of(deep, None) == "text end"
    tags = ["p", "h2", "ul", "blockquote", "pre"]
    page = lambda f: "<main>" + "".join(f"<{tags[f(k)]}>{k}</{tags[f(k)]}>" for k in range(6000)) + "</main>"
    one, two = page(lambda k: (k * k + k // 7) % 5), page(lambda k: (k * 3 + k // 11) % 5)
    wrapper = H.infer([one, two])
    assert wrapper.pages == 2 and H.text_of(one, H.region(wrapper)) == " ".join(map(str, range(6000)))


def test_common_subsequences_in_little_memory(monkeypatch):
    import numpy as np

    r = np.random.default_rng(3)
    a, b = r.integers(0, 5, 300), r.integers(0, 5, 280)
    whole = H._common(a, b)
    monkeypatch.setattr(H, "CELLS", 500)
    halved = H._common(a, b)
    for pairs in (whole, halved):
        assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(set(pairs))
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    assert len(whole) == len(halved) == H._lengths(a, b)[0, 0]


def test_groups_of_any_length_fold():
    row = "".join(f"<{t}>x</{t}>" for t in ("h2", "p", "ul", "ol", "pre", "table", "h3"))
    assert H.infer([f"<main>{row * 4}</main>"]).notation().count("<pre>") == 1


@pytest.mark.parametrize("name", ["article-header-form", "comment-page", "ad widget", "notice"])
def test_a_name_does_not_hide_what_the_wrapper_shows_to_be_the_article(spark, name):
    """Pages without article or main whose only varying part has a misleading name."""
    page = "<div class='top'>Our site</div><div class='{1}'><p>Main text {0} of this page.</p><p class='legal-history'>Law {0}</p><div class='widget-design'>Design {0}</div></div><div class='footer'>Foot {0}</div>"
    df = spark.createDataFrame([(k, "http://h.example/", page.format(k, name)) for k in range(5)], "page_id long, url string, html string").repartition(2)
    want = {k: f"Main text {k} of this page. Law {k} Design {k}" for k in range(5)}
    assert {r.page_id: r.text for r in H.extract(df).collect()} == want


def test_comments_stay_out_however_long(spark):
    page = "<div class='post'><p>Article {0} says what it says.</p></div><div class='comments'>" + "<div class='comment'><b>Reader {0}</b><p>I think {0} that</p></div>" * 9 + "</div>"
    df = spark.createDataFrame([(k, "http://h.example/", page.format(k)) for k in range(5)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in H.extract(df).collect()} == {k: f"Article {k} says what it says." for k in range(5)}


def test_without_wrappers_the_result_is_another(spark):
    """Ablation: the same pages read one by one keep what only the host's wrapper shows to be fixed."""
    page = "<div class='a'><div class='b'>All that we publish is checked by two editors and a lawyer.</div><div class='c'>Report {0}: it rained.</div><div class='b'>Write to us, we like to hear from you at any time.</div></div>"
    df = spark.createDataFrame([(k, "http://h.example/", page.format(k)) for k in range(4)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in H.extract(df).collect()} == {k: f"Report {k}: it rained." for k in range(4)}
    assert "lawyer" in H.text_of(page.format(1), None)


def test_clashing_names_and_odd_rows(spark):
    rows = [(1, "http://h.example/", "<p>a</p>", "x", "y", "z"), (1, "http://h.example/", "<p>a</p>", "x", "y", "z"), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, path string, `page` string")
    out = H.extract(df)
    assert out.columns == ["page_id", "url", "host", "path", "page", "text"]
    assert sorted((r.text, r.host or "") for r in out.collect()) == [("", ""), ("a", "x"), ("a", "x")]


def test_table(spark):
    rows = [(k, f"http://H{k % 2}.example/p{k}", PAGE.format(f"<article><p>text {k}</p></article>"), "extra", "old") for k in range(12)]
    rows += [rows[0], (None, None, None, None, None), (99, "no url", "", "e", "o"), (100, "http://h0.example/x", "<p>other form</p>", "e", "o")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, `a.b` string, text string")
    out = H.extract(df, sample_pages=3)
    assert out.columns == ["page_id", "url", "a.b", "text"]
    got = sorted((repr(r.page_id), r.text) for r in out.collect())
    assert got == sorted([(str(k), f"text {k}") for k in range(12)] + [("0", "text 0"), ("None", ""), ("99", ""), ("100", "other form")])
    assert {r.host: r.pages for r in H.wrappers(df, sample_pages=3).collect()} == {"h0.example": 3, "h1.example": 3}
    assert H.extract(df.limit(0)).count() == 0


def test_query(spark, tiny):
    q = H.op7_html(spark, tiny)
    assert q.columns == ["page_id", "url", "text", "n_chars"]
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{tiny}/pages.parquet").collect()}
    import html
    import re

    for r in q.collect():
        want = re.sub(r"<[^>]*>", " ", re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1])
        assert r.text == re.sub(r"\s+", " ", html.unescape(want)).strip() and r.n_chars == len(r.text)


def test_every_page_of_a_host_forms_its_wrapper(spark):
    """A rare template outside any small sample has its part, and long texts that begin alike differ."""
    rows = [(k, "http://h.example/", PAGE.format(f"<article><p>text {k}</p></article>")) for k in range(60)]
    rare = [(100 + k, "http://h.example/", f"<div class='site'>{'Everything about our site, as on each of its pages. ' * 9}</div><div class='body'><p>rare {k}</p></div>") for k in range(4)]
    long = [(200 + k, "http://l.example/", f"<div class='top'>Hello</div><div class='post'>{'licence ' * 60}{k}</div>") for k in range(5)]
    df = spark.createDataFrame(rows + rare + long, "page_id long, url string, html string").repartition(5)
    assert {r.host: r.pages for r in H.wrappers(df).collect()} == {"h.example": 64, "l.example": 5}
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    assert all(got[k] == f"text {k}" for k in range(60)) and [got[100 + k] for k in range(4)] == [f"rare {k}" for k in range(4)]
    assert all(got[200 + k] == f"{'licence ' * 60}{k}" for k in range(5))


def test_pages_are_read_by_their_wrapper(spark):
    body = "<main><h1>Title {0}</h1><article><p class='lead'>By our own staff, all rights reserved</p><p>one {0}</p><p>two {0}</p><p class='notice'>Mind the gap {0}</p><p class='copyright'>All rights</p></article></main>"
    df = spark.createDataFrame([(k, "http://h.example/", body.format(k)) for k in range(6)], "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    assert got == {k: f"Title {k} one {k} two {k} Mind the gap {k}" for k in range(6)}
