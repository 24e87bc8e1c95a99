from __future__ import annotations

import pytest

from courtside.llm import html_text as h

PAGES = "page_id long, url string, html string, text string, host string, digest string"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a b"), ("<p>a<b>b</b>c<br>d</p>", "abc d"),
        ("<body><nav><ul><li>x</ul></nav><article><h1>T&eacute;</h1><p>one\n two<p><b>three<br><p>four</article><footer>f</footer>", "Té one two three four"),
        ("<script>var t='</p>';</script><style>p{}</style><p>x<!-- no <b> --> y</p>", "x y"), ("<title>t</title><p>x &lt;b&gt; &#233;&nbsp;y", "x <b> é y"),
        ('<div class="ad">buy</div><div id="cookie-notice">ok</div><main><p>x</p><aside>s</aside><div class="comments">c</div><form>f</form></main>', "x"),
        ("<article><p>a</p></article><p>outside</p><article>b</article>", "a b"), ("<p>1 < 2 & 3 <4</p>", "1 < 2 & 3 <4"), ("<ul><li>a<li>b</ul>", "a b"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<p>a</div></section>b", "a b"), ('<p title="a>b">x</p>', "x"), ("<p>unclosed <b", "unclosed <b"),
        ("<textarea><p>x</textarea><p>y", "y"), ("<div hidden>x</div><div role=navigation>y</div><div>z</div>", "z"), ("<script>never closed", ""),
        ('<div class="site-header">s</div><main><header><h1>T</h1></header><div class="post-header">by me</div><p>x</main>', "T by me x"),
    ],
)
def test_text_of_a_page(source, text):
    assert h.Page(source).text() == text


def test_hosts():
    assert [h.host_of(u) for u in ("HTTP://U:p@Www.A.com:80/x", "https://a.b?c", None, "nothing", "ftp://h#f")] == ["www.a.com", "a.b", "", "", "h"]


def site(n, host="a.com"):
    box = "<div><p>Join our   list</p></div>"
    return [(i, f"http://{host}/{i}", f"<body>{box}<div><h2>Story {i}</h2><p>Only here {i}</p></div><p>Shared line</p></body>") for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", "h", "d") for r in rows], PAGES)


def text_by_page(df):
    return {r["page_id"]: r["text"] for r in df.collect()}


@pytest.mark.parametrize("max_sent", [h.MAX_SENT, 0])
def test_templates_of_a_host_go(spark, max_sent):
    rows = site(12) + [(100 + i, u, s) for i, u, s in site(3, "b.com")]
    found = text_by_page(h.main_text(frame(spark, rows), max_sent=max_sent))
    assert found[3] == "Story 3 Only here 3"
    assert found[101] == "Join our list Story 1 Only here 1 Shared line"


def test_copies_are_no_evidence_of_a_template(spark):
    page = "<body><div><p>An article that was posted often</p></div></body>"
    found = text_by_page(h.main_text(frame(spark, [(i, f"http://a.com/{i}", page) for i in range(30)])))
    assert set(found.values()) == {"An article that was posted often"}


def test_prose_in_articles_is_no_template(spark):
    rows = [(i, "http://a.com", f"<article><p>Common line</p><p>own {i}</p><div class=x>Follow us</div></article>") for i in range(15)]
    found = text_by_page(h.main_text(frame(spark, rows)))
    assert found[4] == "Common line own 4"


def test_an_article_deletes_nothing_that_does_not_recur(spark):
    page = "<body><p>Lead {0}</p><div><p>Body {0}</p></div><div>Site box</div><article><p>Teaser</p></article></body>"
    rows = [(i, "http://a.com", page.format(i)) for i in range(12)]
    assert text_by_page(h.main_text(frame(spark, rows)))[4] == "Lead 4 Body 4 Teaser"


def test_prose_that_recurs_in_very_many_articles_goes(spark):
    rows = [(i, "http://a.com", f"<article><h1>T {i}</h1><p>own {i}</p><p>Read our notice</p></article>") for i in range(h.MIN_PROSE_PAGES)]
    rows += [(100 + i, "http://b.com", f"<article><p>posted often</p></article><div>by {i}</div>") for i in range(30)]
    found = text_by_page(h.main_text(frame(spark, rows)))
    assert found[4] == "T 4 own 4" and found[104] == "posted often by 4"


def test_the_verdict_on_a_block_does_not_depend_on_the_size_of_the_host(spark):
    page = "<body><div>Campaign</div><div>Story {0}</div></body>"
    rows = [(i, "http://a.com", page.format(i)) for i in range(12)] + [(100 + i, "http://a.com", f"<p>Other {i}</p>") for i in range(1500)]
    rows += [(5000 + i, "http://few.com", page.format(i)) for i in range(5)]
    found = text_by_page(h.main_text(frame(spark, rows)))
    assert found[3] == "Story 3" and found[103] == "Other 3" and found[5003] == "Story 3"


def test_items_and_cells_of_articles_stay(spark):
    own = "<ul><li>Salt</li><li>Item {0}</li></ul><table><tr><td>1</td><td>{0}</td></tr></table><dl><dt>Time<dd>1 h</dl><figure><figcaption>Photo</figcaption>{0}</figure>"
    for n, within in ((12, 12), (6, 4), (40, 40)):
        rows = [(i, "http://a.com", f"<article><h1>T {i}</h1>{own.format(i)}</article>" if i < within else f"<p>other {i}</p>") for i in range(n)]
        # The list of terms is the same in all articles and goes as a whole, if there are enough of them.
        terms = "" if n >= h.MIN_PAGES else "Time 1 h "
        assert text_by_page(h.main_text(frame(spark, rows)))[3] == f"T 3 Salt Item 3 1 3 {terms}Photo 3"


def test_spec_sheets_without_an_article_keep_their_cells(spark):
    page = "<body><h1>Device {0}</h1><table><tr><th>Weight</th><td>1 kg</td></tr><tr><th>Number</th><td>{0}</td></tr></table></body>"
    found = text_by_page(h.main_text(frame(spark, [(i, "http://a.com", page.format(i)) for i in range(30)])))
    assert found[7] == "Device 7 Weight 1 kg Number 7"


def test_a_sentence_of_some_articles_stays(spark):
    rows = [(i, "http://a.com", f"<article><p>own {i}</p><p>{'It was a good day.' if i < 25 else f'end {i}'}</p></article>") for i in range(50)]
    assert text_by_page(h.main_text(frame(spark, rows)))[3] == "own 3 It was a good day."


def test_templates_by_counting_in_one_place(spark):
    import random
    from collections import defaultdict

    rng = random.Random(4)
    block = lambda: f"<{(t := rng.choice(['p', 'div', 'li', 'ul', 'td', 'section']))}>{rng.choice('abc')}{rng.choice(['', '', rng.randrange(9)])}</{t}>"
    rows = []
    for i in range(240):
        held = "".join(block() for _ in range(rng.randrange(12)))
        rows.append((i, f"http://{rng.choice('xyz')}.com", rng.choice(["<div>{}</div>", "{}", "<article>{}</article><div>s</div>", "<main>{}</main>"]).format(held)))
    pages, articles, seen = defaultdict(set), defaultdict(set), defaultdict(set)
    for _, url, source in rows:
        content, of_articles, outside, inside = h.Page(source).evidence()
        pages[url].add(content)
        if of_articles is not None:
            articles[url].add(of_articles)
        for key in outside:
            seen[url, key].add(content)
        for key in inside:
            seen[url, key].add(of_articles)
    want = set()
    for (url, key), n in ((k, len(v)) for k, v in seen.items()):
        if key & 2:
            least, share = (h.MIN_PROSE_PAGES, h.PROSE_SHARE) if key & 1 else (h.MIN_PAGES, h.ARTICLE_SHARE)
            goes = n >= least and n >= share * len(articles[url])
        else:
            goes = n >= h.FEW_PAGES and (n >= h.MIN_PAGES or n >= h.FEW_SHARE * len(pages[url]))
        if goes:
            want.add((h.host_of(url), key))
    found = h.site_templates(h.described(frame(spark, rows)))
    assert {tuple(r) for r in found.collect()} == want and len(want) > 5


def test_hashes_are_those_of_the_subtree():
    keys = lambda source: {key for key, _ in h.Page(source).subtrees()}
    inner = "<div class='a  b'><p>x <b>y</b></p>z</div>"
    assert keys(inner) <= keys(f"<section>{inner}</section>") and keys(inner) == keys(inner.replace("  ", "\n").replace("x ", "x\t"))
    for other in ("<div class='a b'><p>x <b>y</b>z</p></div>", "<div class='a b'><p>x <i>y</i></p>z</div>", "<div class=c><p>x <b>y</b></p>z</div>"):
        assert h.Page(other).subtrees()[-1][0] not in keys(inner)


def test_end_tags_without_a_start_cost_nothing():
    import time

    times = []
    for n in (4000, 16_000):
        start = time.perf_counter()
        page = h.Page("</i>" * n + "<div>" * n + "</p></b>" * n + "x")
        assert page.text(frozenset()) == "x" and len(page.subtrees()) == n
        times.append(time.perf_counter() - start)
    assert times[1] < 10 * times[0]


def test_awkward_rows(spark):
    long = "<p>" + "<b>x</b> y " * 30_000
    deep = "<div>" * 5000 + "in" + "</div>" * 5000
    rows = [(1, None, None), (2, "u", ""), (None, None, "<p>x"), (None, None, None), (3, "http://a", "<p>r"), (3, "http://a", "<p>r"), (4, "http://a", long), (5, "http://b", deep)]
    found = h.main_text(frame(spark, rows))
    told = sorted(((r["page_id"], r["url"], r["text"][:9], r["n_chars"]) for r in found.collect()), key=repr)
    want = [(1, None, "", 0), (2, "u", "", 0), (None, None, "x", 1), (None, None, "", 0), (3, "http://a", "r", 1), (3, "http://a", "r", 1)]
    want += [(4, "http://a", "x y x y x", 30_000 * 4 - 1), (5, "http://b", "in", 2)]
    assert told == sorted(want, key=repr)
    assert h.main_text(frame(spark, [])).count() == 0
