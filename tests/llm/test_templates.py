import html

import pytest

from fleetspark.llm import templates
from tests.llm.conftest import prose


def article(blocks, menu="x"):
    body = "".join(f"<p>{html.escape(b)}</p>" for b in blocks)
    return (f'<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p>";</script></head><body><nav><ul><li>'
            f'<a href="/m">{menu}</a></li></ul></nav><!-- ad --><div class="ad">Buy</div><article>{body}</article>'
            f'<footer>&copy; x</footer></body></html>')


def plain(blocks, n):
    """A page without article or main: what is data shows only beside the host's other pages."""
    links = "".join(f'<a href="/{i}">Section {i * n}</a> ' for i in range(4))
    body = "".join(f"<p>{html.escape(b)}</p>" for b in blocks)
    box = "<div><span>This site uses things</span></div>" if n % 2 else ""  # on some pages only
    return f"<html><body><div>{links}</div><div>Welcome to our site</div>{body}<section>All rights reserved</section>{box}</body></html>"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("no markup  at\nall", "no markup at all"), ("<p>a<p>b", "a\n\nb"), ("<p>a<br>b<b>c</b> d", "a bc d"),
    ("<p>1 &lt; 2 &amp;amp; &#233;&nbsp;x</p>", "1 < 2 &amp; é x"), ("<script>a</p></script><p>b</p><style>c", "b"),
    ("<!-- <p>no</p> --><p>yes</p><!-- open", "yes"), ('<p title="a>b">c</p>', "c"), ("<p title='x>c</p><p>d", "c\n\nd"),
    ("<ul><li>a<li>b</ul>c", "a\n\nb\n\nc"), ("a < b and c > d", "a < b and c > d"), ("<p><b>a<br><p>b</b></p>c", "a\n\nb\n\nc"),
    ("<main><h1>T</h1><p>x</p><aside>s</aside></main><p>out</p>", "T\n\nx"), ("<header>h</header><p>x</p><footer>f</footer>", "x"),
    ("<article><p>x</p><div class='comments'><p>no</p></div><form>f</form><p>y</p></article>", "x\n\ny"),
    ("<div id=sidebar>s</div><div class='cookie-notice'>c</div><div class='download'>d</div>", "d"),
    ("<article>a<div>b</article>c", "a\n\nb"), ("</p></div><p>x</p></article>", "x"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
])
def test_pages(page, text):
    assert templates.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    ('<body><article class="post has-sidebar"><p>all of it</p></article><div class="ad">Buy</div></body>', "all of it"),
    ('<div class="content no-comments"><p>all of it</p></div><div class="sidebar">s</div>', "all of it"),
    ('<article class="search-result"><p>all of it</p></article><footer>f</footer>', "all of it"),
    ('<body><form action="x"><nav>n</nav><div><p>all</p><p>of it</p></div><fieldset>go</fieldset></form></body>', "all\n\nof it"),
    ('<form><div class="ad">Buy</div><article><p>all of it</p><form>f</form></article></form>', "all of it"),
    ('<article><p class="alert-free">all</p><p>of it</p></article>', "all\n\nof it"),
    ("<main><p>The whole of a long text.</p><article><p>A teaser</p></article></main>", "The whole of a long text.\n\nA teaser"),
    ("<main><p>List</p><article><p>A long article.</p></article><article><p>Another one.</p></article></main>",
     "A long article.\n\nAnother one."),
    ('<article><h1></h1><p></p></article><div class="ad">Buy this now</div><footer>f</footer>', ""),
    ('<article class="with-social"><p>x</p><article class="comment"><p>I think so too, and more</p></article></article>', "x"),
    ('<p>short</p><div id="comments"><p>A comment much longer than the text itself</p></div>', "short"),
    ('<div class="sidebar-layout">' + "<p>the text</p>" * 3 + "</div><p>x</p>", "the text\n\nthe text\n\nthe text\n\nx"),
])
def test_names_do_not_lose_articles(page, text):
    assert templates.main_text(page) == text


def rows_of(frame):
    return {r.page_id: r.text for r in templates.extract_pages(frame).collect()}


def test_a_template_shows_beside_its_data(spark):
    pages, want = [], {}
    for i in range(12):
        blocks = [prose(i * 10 + k, 30) for k in range(1 + i % 4)]
        pages.append((i, f"http://{'www.' if i % 2 else ''}Plain.example/{i}", plain(blocks, i + 1)))
        want[i] = "\n\n".join(blocks)
        pages.append((100 + i, f"https://art.example:8080/{i}", article(blocks)))
        want[100 + i] = "\n\n".join(blocks)
    pages += [(200 + i, "http://copies.example/x", plain(["the same on all pages"], 1)) for i in range(8)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
    got = rows_of(frame)
    assert {k: got[k] for k in want} == want
    # all pages of a host alike: nothing tells data from template, so nothing but menus goes
    assert all("the same on all pages" in got[200 + i] for i in range(8))


def frame_of(spark, pages):
    return spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)


def test_tokens_of_one_class_share_their_vector(spark):
    pages = [(i, "http://h.example/", article([prose(i * 10 + k, 9) for k in range(1 + i % 4)])) for i in range(9)]
    counts = templates.element_counts(templates.parsed(frame_of(spark, pages))).collect()
    vector = {r.path: (r.v0, r.v1, r.v2) for r in counts}
    of = lambda path: vector[templates.path_of(path)]
    assert of("/html/body/article") == of("/html/body/nav/ul") == of("/html/body") == vector[0]
    assert of("/html/body/article/p") != of("/html/body/article") and of("/html/body/nav/ul/li") == of("/html/body")


def site(n, extra=""):
    """Pages of several shapes; ``section`` is rare, notices stand in articles, teasers end alike."""
    pages, want = [], {}
    for i in range(n):
        own = [prose(i * 10 + k, 40) for k in range(2 + i % 3)]
        teasers = [prose(5000 + i * 10 + k, 8) for k in range(1 + i % 4)]
        items = "".join(f"<div class=item><p>{t}</p><p>Read more</p></div>" for t in teasers) if i % 2 and i % 9 != 4 else ""
        note = "<p>We use cookies on this site</p>" if i % 3 else ""
        body = "".join(f"<p>{t}</p>" for t in own)
        rare = f"<section><p>{prose(9000 + i, 5)}</p><p>Only here is this said</p></section>" if i % 9 == 4 else ""
        pages.append((i, "http://site.example/", f"<html><body><article>{note}{body}{items}<p>All rights reserved</p>{rare}</article>{extra}</body></html>"))
        want[i] = own, teasers if items else [], [prose(9000 + i, 5)] if rare else []
    return pages, want


def test_template_texts_within_articles_go(spark):
    pages, want = site(108)
    got = rows_of(frame_of(spark, pages))
    for i, (own, teasers, rare) in want.items():
        # a notice that only some pages of a shape have, among paragraphs, is in no class: it stays. All pages with
        # the rare section have it
        note = ["We use cookies on this site"] if i % 3 and not rare else []
        assert got[i].split("\n\n") == note + own + teasers + rare, i


def unmarked(i, words=60):
    """A title, a text in its own box, and boxes beside it that differ from page to page and are called nothing."""
    own = [prose(i * 7 + k, words) for k in range(2)]
    page = (f"<html><body><div class=x1><p>{prose(700 + i, 12)}</p></div><h1>{prose(900 + i, 4)}</h1>"
            f"<div class=x2><p>{own[0]}</p><div><p>{own[1]}</p></div></div><div class=x3>{prose(800 + i, 15)}</div></body></html>")
    return (i, "http://boxes.example/", page), "\n\n".join([prose(900 + i, 4), *own])


def test_the_slot_of_the_articles_shows_in_many_pages(spark):
    made = [unmarked(i) for i in range(12)]
    assert rows_of(frame_of(spark, [p for p, _ in made])) == {p[0]: text for p, text in made}
    few = rows_of(frame_of(spark, [p for p, _ in made[:4]]))  # too few pages: all boxes stay
    assert all(prose(700 + i, 12) in few[i] and prose(800 + i, 15) in few[i] for i in range(4))
    # one page whose own text is short does not move the slot
    short, text = unmarked(50, 3)
    assert rows_of(frame_of(spark, [p for p, _ in made] + [short]))[50] == text


def test_articles_side_by_side_are_one_slot(spark):
    pages, want = [], {}
    for i in range(8):
        own = [prose(i * 5 + k, 40 if k else 90) for k in range(3)]
        body = "".join(f"<article><p>{t}</p></article>" for t in own)
        pages.append((i, "http://list.example/", f"<html><body><div>{prose(300 + i, 9)}</div><div>{body}</div><nav>n</nav></body></html>"))
        want[i] = "\n\n".join(own)
    assert rows_of(frame_of(spark, pages)) == want
    found = templates.regions(templates.parsed(frame_of(spark, pages))).collect()
    path = templates.step(templates.path_of("/html/body"), "div2")
    assert [r.region for r in found] == [[0, templates.path_of("/html"), templates.path_of("/html/body"), path]]


def test_region_of_the_test_pages_is_their_article(spark, sf):
    """By their classes alone: names of elements have no part in where most of a shape's text stands."""
    pages = spark.read.parquet(f"{sf.replace('0.001', '0.1')}/pages.parquet")
    found = templates.regions(templates.parsed(pages)).collect()
    want = [0, *[templates.path_of(p) for p in ("/html", "/html/body", "/html/body/article")]]
    assert len(found) > 40 and all(r.region == want for r in found)


def test_few_pages_or_copies_prove_nothing(spark):
    for pages in (site(108)[0][:4], [(k, "http://site.example/", site(3)[0][2][2]) for k in range(20)]):
        got = rows_of(frame_of(spark, pages))
        assert all("All rights reserved" in t for t in got.values())
    # near copies of one article agree in most of their text, which is no template
    copies = [(k, "http://c.example/", f"<article><h1>Title {k}</h1><div>{prose(1, 80)}</div><p>{prose(k, 5)}</p></article>") for k in range(9)]
    assert all(prose(1, 80) in t for t in rows_of(frame_of(spark, copies)).values())


def test_classes_equal_counting_every_page(spark):
    """The template of each shape by comparing lists of counts, one for each page."""
    pages, _ = site(60, "<div><a href=x>One</a> <a href=y>Two</a></div><div>Bottom line</div>")
    pages += [(100 + k, "http://site.example/", pages[k][2]) for k in range(30)]  # copies
    pages += [(200 + i, "http://plain.example/", plain([prose(i * 10 + k, 30) for k in range(1 + i % 4)], i)) for i in range(14)]
    groups, want = {}, {}
    for _, url, page in pages:
        p = templates.parse(page)
        groups.setdefault((url.split("/")[2], p.shape), []).append((page, p))
    for key, held in groups.items():
        tokens = {(b.path, b.text): b for _, p in held for b in p.blocks}
        menus = set()
        for path in {b.path for b in tokens.values()}:
            own = [b for _, p in held for b in p.blocks if b.path == path]
            if sum(b.linked for b in own) > 0.5 * sum(len(b.text) for b in own):
                menus.add(path)
        fixed = {}
        for (path, text), b in tokens.items():
            count = [sum((x.path, x.text) == (path, text) for x in p.blocks) for _, p in held]
            around = [[p.paths.count(x) for _, p in held] for x in (b.path, b.container)] + [[1] * len(held)]
            if len({page for (page, _), n in zip(held, count) if n}) >= 5 and count in around:
                fixed[path, text] = sum(n * len(text) * (b.kind > 0) for n in count)
        articles = sum(len(b.text) for _, p in held for b in p.blocks if b.kind)
        if sum(fixed.values()) > 0.2 * articles:
            fixed = {t: n for t, n in fixed.items() if not n}
        if menus or fixed:
            want[key] = sorted(menus | {templates.text_token(*t) for t in fixed})
    got = {(r.host, r.shape): r.dropped for r in templates.host_templates(templates.parsed(frame_of(spark, pages))).collect()}
    assert got == want and sum(map(len, want.values())) > 10


def test_odd_pages(spark):
    long_page = article([prose(i, 300) for i in range(200)])
    rows = [(1, None, None), (1, None, None), (None, "no url", "<p>x</p>"), (2, "http://a/", ""), (3, "http://a/", long_page), (4, "http://[", "<p>y")]
    frame = spark.createDataFrame([(*r, "h", "t", 5) for r in rows], "page_id long, url string, html string, host string, text string, dropped int")
    out = templates.extract_pages(frame)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(out.collect(), key=repr)
    assert [(r.page_id, r.text, r.n_chars) for r in got if r.page_id == 1] == [(1, "", 0)] * 2
    assert len(got) == 6 and {r.text for r in got if r.page_id in (None, 4)} == {"x", "y"}
    assert max(r.n_chars for r in got) == len("\n\n".join(prose(i, 300) for i in range(200)))
    assert templates.extract_pages(frame.limit(0)).collect() == []


def test_articles_of_the_test_pages(spark, sf):
    import re

    frame = spark.read.parquet(f"{sf}/pages.parquet")
    got = rows_of(frame)
    for r in frame.collect():
        inside = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        parts = re.split(r"</?(?:p|h1)>", inside.replace("<b>", "").replace("</b>", "").replace("<br>", " "))
        want = [" ".join(html.unescape(x).split()) for x in parts]
        assert got[r.page_id] == "\n\n".join(x for x in want if x)
