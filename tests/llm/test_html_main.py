import re
import time
from html import unescape

from nocturne.llm.html_main import best, choose, extract, parse, render
from nocturne.llm.queries import op7_html_extraction

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script><style>p{}</style></head><body>
<header>Site</header><nav><ul><li><a href=/a>A</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="ad">Buy now</div><article id=main-7 class='post p%d'><h1>Head&nbsp;line &amp; more</h1><p>First <b>bold
 text</b>.<br>Next<p>Second &#8364; &lt;tag&gt;<form><input value=x>Send</form><ul><li>one<li>two</ul>
<div class="comments"><p>I disagree</p></div></article><aside>Side</aside><footer>&copy; me</footer></body></html>"""
TEXT = "Head line & more\nFirst bold text. Next\nSecond € <tag>\none\ntwo"


def test_article_alone_remains():
    assert render(best(parse(PAGE % 3))) == TEXT


def test_broken_markup():
    assert render(best(parse("<div><p>Open text <b>and <i>more"))) == "Open text and more"
    assert render(best(parse("plain words"))) == "plain words"
    assert render(best(parse("<script>never closed <p>x"))) == ""
    assert render(best(parse("a < b and c > d"))) == "a < b and c > d"
    assert render(best(parse(""))) == ""


def test_hosts_vote(spark, scratch):
    thin = "<body><div class=story>short</div><div class=links>" + "<p>teaser words that are long</p>" * 3 + "</div></body>"
    full = "<body><div class=story>" + "<p>story words of some length here</p>" * 9 + "</div><div class=links><p>teaser</p></div></body>"
    rows = [(i, f"http://h.example.com/{i}", full, "clash") for i in range(5)] + [(5, "http://h.example.com/5", thin, "clash"), (6, None, None, "clash"), (7, "x", "", "clash"), (8, "http://other.org/", thin, "clash")]
    rows.append(rows[0])
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), scratch).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[5].text == "short" and by[8].text != "short"
    assert by[6].text == "" and by[6].n_chars == 0 and by[7].text == ""
    assert extract(spark.createDataFrame([], "page_id long, url string, html string"), scratch).count() == 0


def test_layouts_of_one_host(spark, scratch):
    long = "<p>words of the article that go on and on</p>" * 20
    pages = [f"<body><div>{long}</div></body>"] * 8 + [f"<body><div>teaser</div><article>{long}</article></body>"] * 3
    pages += ["<body><div>teaser</div><article><p>short article</p></article></body>", f"<body><div>teaser</div><section>{long}</section></body>"]
    df = spark.createDataFrame([(i, f"http://h.example.com/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract(df, scratch).collect()}
    full = "\n".join(["words of the article that go on and on"] * 20)
    assert got == {i: "short article" if i == 11 else full for i in range(13)}


def test_names_of_wrappers():
    text = "<p>words of the article that go on and on</p>" * 9
    plain = "\n".join(["words of the article that go on and on"] * 9)
    for names in ("content has-sidebar", "no-sidebar", "post social", "layout sidebar"):
        page = f"<body><div class='{names}'>{text}<div class=share>Share this</div></div><div class=sidebar><p>Side</p></div></body>"
        assert render(best(parse(page))) == plain, names
    comments = f"<body><div class=story>{text}</div><div class=comments>{text * 4}</div></body>"
    assert render(best(parse(comments))) == plain


def test_names_are_no_verdict():
    text = "<p>words of the article that go on and on</p>" * 9
    plain = "\n".join(["words of the article that go on and on"] * 9)
    cases = {
        f"<body><div class='entry-content no-sidebar'>{text}</div><div class=box><p>junk beside it</p></div></body>": plain,
        f"<body><article>{text}<p class='share-price'>The price of a share is 7.</p></article></body>": plain + "\nThe price of a share is 7.",
        f"<body><article><h1>Outer</h1>{text}<article class=quote><p>An inner article.</p></article></article></body>": "Outer\n" + plain + "\nAn inner article.",
        f"<body><form id=aspnetForm><input name=q><div class=page>{text}</div><button>Send</button></form></body>": plain,
        f"<body><main>{text}<form><label>Your name</label></form></main></body>": plain,
        f"<body><article>{text}<div class='ad-slot-top'>Buy</div><div id=site-footer>Us</div><ul class=related-posts><li>More</ul><div class='article-comments'><p>No!</p></div></article></body>": plain,
        f"<body><article><div class=entry-header><h1>Title</h1></div>{text}<p id=comment-free-zone>A last word.</p></article></body>": "Title\n" + plain + "\nA last word.",
    }
    for page, expect in cases.items():
        assert render(best(parse(page))) == expect, page


def test_markup_of_any_kind():
    cases = {
        "<p title=\"a > b\">one</p><p title='>'>two</p><p data-x=it's>three</p>": "one\ntwo\nthree",
        "<p title=\"never closed>one</p><p>two</p>": "one\ntwo",
        "<p>a<!-- x > y --></p><!-- never closed <p>b": "a",
        "<p>a</p></div></span></p><p>b": "a\nb",
        "<ul><li>a<ul><li>b<li>c</ul><li>d</ul>": "a\nb\nc\nd",
        "<table><tr><td>a<td>b<tr><td>c<table><tr><td>d</table>e</table>": "a\nb\nc\nd\ne",
        "1 < 2 <3 > 2<": "1 < 2 <3 > 2<",
        "kept<a href='x": "kept",
        "<p><b>bold<br><p>next</b> text &amp;lt; &#x41;&nbsp;B": "bold\nnext text &lt; A B",
        "<P CLASS=x/>kept<br/>too": "kept too",
    }
    for page, expect in cases.items():
        assert render(parse(page)) == expect, page


def test_deep_and_hostile_pages_take_linear_time():
    n = 100_000
    start = time.monotonic()
    assert render(best(parse("<div>" * n + "deep" + "</div>" * n))) == "deep"
    n //= 4
    for page in ("<div>" * n + "x" + "</span></p></li>" * n, "<p><div>" + "<span>" * n + "<p>x" * n, "<em><table><td>" + "<span>" * n + "</em>" * n, "<a '" * n, '<a ="' * n, '<a ="<b>' * n + '"', "<!" * n, "<!--" * n, "< " * n, "<div class=ad>" * n + "x" * n, "<li><td><dd>" * n):
        root = parse(page)
        choose(root, [root.order[-1].hash], 1.0)
    assert time.monotonic() - start < 60


def template_text(html):
    """The article of the tables' template, by patterns of its own."""
    inner = re.search(r"<article>(.*?)</article>", html, re.S).group(1)
    blocks = re.split(r"</?(?:h1|h2|p|ul|li|blockquote|pre|table|tr|td)>", inner)
    return "\n".join(t for b in blocks if (t := " ".join(unescape(re.sub(r"<[^>]+>", lambda m: " " if m.group() == "<br>" else "", b)).split())))


def test_pages_of_the_table_have_their_article(spark, scratch):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for hosts in (10_000, 0):  # broadcast, and joined by salted host
        got = {r.page_id: r.text for r in extract(pages, scratch, broadcast_hosts=hosts).collect()}
        assert got.keys() == html.keys()
        for i, text in got.items():
            assert text == (template_text(html[i]) if html[i] else ""), i


def test_long_page(spark, scratch):
    page = "<body><article>" + "".join(f"<p>paragraph {i}</p>" for i in range(20000)) + "</article></body>"
    row = extract(spark.createDataFrame([(1, "http://a.b/", page)], "page_id long, url string, html string"), scratch).first()
    assert row.text.count("\n") == 19999 and row.n_chars == len(row.text)


def test_query_over_a_table(spark, sf_dir):
    rows = op7_html_extraction(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert all(r.n_chars == len(r.text) and r.host_path == "html>body>article" for r in rows)
    assert not any("track(" in r.text or "<" in r.text and "</" in r.text for r in rows)


SENTENCES = [f"This is sentence number {i} of the article and it has some words." for i in range(20)]


def paras(a, b):
    return "".join(f"<p>{x}</p>" for x in SENTENCES[a:b])


def told(a, b):
    return "\n".join(SENTENCES[a:b])


def varied(layout):
    """Twenty pages of a host, in whose text every @ is the page's number."""
    return [(i, f"http://h.example.com/{i}", layout.replace("article and", f"article {i} and")) for i in range(20)]


LAYOUTS = {
    "intro and details": (f"<body><div id=wrap><div class=intro>{paras(0, 6)}</div><div class=details>{paras(6, 20)}</div></div></body>", told(0, 20)),
    "lead, more, end": (f"<body><nav><a href=/>Home</a></nav><div class=lead>{paras(0, 4)}</div><div class=more>{paras(4, 13)}</div><div class=end>{paras(13, 16)}</div><footer>Us</footer></body>", told(0, 16)),
    "heading between parts": (f"<body><div class=one>{paras(0, 8)}</div><h2>More of it</h2><div class=two>{paras(8, 16)}</div></body>", told(0, 8) + "\nMore of it\n" + told(8, 16)),
    "advert by size": (f"<body><article>{paras(0, 5)}<div class=ad-300x250>Buy this now</div>{paras(5, 9)}</article></body>", told(0, 9)),
    "cookie notice": (f"<body><article>{paras(0, 9)}<div class=cookie-law-info><p>We use cookies to make this site work.</p></div></article></body>", told(0, 9)),
    "comments": (f"<body><article>{paras(0, 9)}<div class=comment-thread><p>I think article and author are wrong about it.</p></div></article></body>", told(0, 9)),
    "dialog": (f"<body><dialog open>{paras(0, 9)}</dialog></body>", told(0, 9)),
    "box of one text": (f"<body><article>{paras(0, 9)}<div class=x1><p>Our letter comes each week, leave us your address.</p></div></article></body>", told(0, 9)),
    "list of links beside": (f"<body><div class=col1>{paras(0, 9)}</div><div class=col2>{''.join(f'<p><a href=/{i}>Another article and its long name {i}</a></p>' for i in range(9))}</div></body>", told(0, 9)),
    "sections": (f"<body><main><section class=a>{paras(0, 3)}</section><section class=b>{paras(3, 9)}</section></main></body>", told(0, 9)),
    "links inside": (f"<body><article>{paras(0, 4)}<ul><li><a href=/x>A source of the article and more</a></li></ul>{paras(4, 9)}</article></body>", told(0, 4) + "\nA source of the article and more\n" + told(4, 9)),
    "wrapper named as layout": (f"<body><div class='page-banner-off sidebar-right-layout'><div class=text>{paras(0, 9)}</div></div></body>", told(0, 9)),
}


def test_layouts_by_hand(spark, scratch):
    rows, want = [], {}
    for k, (layout, text) in enumerate(LAYOUTS.values()):
        for i, url, page in varied(layout):
            rows.append((100 * k + i, url.replace("//h", f"//h{k}"), page))
            want[100 * k + i] = text.replace("article and", f"article {i} and")
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string"), scratch).collect()}
    for k, name in enumerate(LAYOUTS):
        for i in range(20):
            assert got[100 * k + i] == want[100 * k + i], (name, i)


def test_layouts_of_single_pages():
    for name, (layout, text) in LAYOUTS.items():
        if name != "box of one text":  # only its repetition tells it
            assert choose(parse(layout), [], 0.0) == text, name


def test_copies_are_no_furniture(spark, scratch):
    page = f"<body><div class=a><div class=b>{paras(0, 9)}</div><div class=c>{paras(9, 12)}</div></div></body>"
    other = f"<body><div class=a><div class=b>{paras(2, 12)}</div></div></body>"
    rows = [(i, "http://h.example.com/", page if i % 2 else other) for i in range(12)] + [(20 + i, "http://g.example.com/", page) for i in range(12)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string"), scratch).collect()}
    assert all(t == (told(0, 12) if i >= 20 or i % 2 else told(2, 12)) for i, t in got.items())
