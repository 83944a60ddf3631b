"""Wrappers of small page families, and the text they leave."""

import random

from tests.conftest import rows
from tracemill.llm import html_extraction as he
from tracemill.llm.markup import Page
from tests.llm.conftest import CLASHING

SPEC = "page_id long, url string, html string"


def folded(html):
    return he.fold(Page(html, he.unwanted).root.items)


def wrapper(*pages):
    out = folded(pages[0])
    for page in pages[1:]:
        out = he.align(out, folded(page))
    return he.shown(out)


def test_repetitions_options_and_slots():
    assert wrapper("<ul><li>a</li><li>b</li><li>c</li></ul>") == "ul(li(#)+)"
    assert wrapper("<h1>x</h1><p>a", "<h1>y</h1><div>ad</div><p>a<p>b") == "h1(#) div(#)? p(#)+"
    assert wrapper("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "<dl><dt>a<dd>b</dl>") == "dl((dt(#) dd(#))+)"
    assert wrapper("<div class=item><h2>a</h2><p>b</p></div><div class=item><h2>c</h2></div>") == "div.item(h2(#) p(#)?)+"
    assert wrapper("<div>a</div><p>b</p>", "<p>c</p>") == "div(#)? p(#)"


def test_long_sequences_become_one_group_of_options(monkeypatch):
    monkeypatch.setattr(he, "WIDE", 6)
    assert wrapper("<h2>a</h2><p>a<ul><li>x</ul><h2>b</h2><ul><li>c</ul><p>a<h2>d</h2><p>e") == "(h2(#)? p(#)? ul(li(#))?)+"


def page(title, body, extra="", nav="Home"):
    return f"""<!DOCTYPE html><html><head><title>{title} | Site</title><style>p {{ x: "</p>" }}</style><script>var a = "<p>no</p>";</script></head>
<body class=page><header id="top"><h2>The site</h2></header><nav><ul><li><a href=/>{nav}</a><li><a href=/b>More</a></ul></nav>
<div class="cookie-notice">We use cookies</div><!-- <p>hidden</p> -->
<div id=wrap><article class="post"><h1>{title}</h1>{body}<div class="share-buttons">Share <a href=x>this</a></div></article>
<aside><h3>Popular</h3><p>Another story that everybody reads today</p></aside>
<form action=/s><label>Name</label><input name=q><button>Go</button></form>{extra}
<section id="comments"><h3>2 comments</h3><article class="comment"><p>First! A long comment, as long as an article nearly.</p></article></section></div>
<footer><p>&copy; 2020 Site</p></footer></body></html>"""


def test_article_without_the_rest(table):
    bodies = [f"<p>Text {n} &amp; more &lt;of&gt; it&nbsp;here,\n  <b>bold</b><i>er</i> and <a href=x>a link</a>.<br>New line {n}.</p><ul><li>one {n}<li>two {n}</ul>"
              for n in range(9)]
    bodies[3] += "<blockquote>Said &eacute; &#233; &#x65;</blockquote><div class=advert>Buy!</div>"
    pages = [(n, f"https://a.example.com/{n}", page(f"Title {n}", body, nav=f"Home {n}")) for n, body in enumerate(bodies)]
    out = {r.page_id: r.text for r in he.extract(table(pages, SPEC)).collect()}
    for n in range(9):
        wanted = [f"Title {n}", f"Text {n} & more <of> it here, bolder and a link. New line {n}.", f"one {n}", f"two {n}"]
        assert out[n] == "\n\n".join(wanted + (["Said é é e"] if n == 3 else []))


def test_host_without_article_takes_the_block_with_the_text(table):
    def plain(n):
        links = "".join(f"<a href=/{i}>Topic {i} </a>" for i in range(9))
        return (f"<body><div>{links}</div><div><h1>About {n}</h1><p>Paragraph {n} with a good number of words in it.</p>"
                f"<p>And one more, number {n}, of words that are no link.</p></div><div><p>Always the same line at the end of pages.</p></div>")
    out = {r.page_id: r.text for r in he.extract(table([(n, "http://b.example.com/x", plain(n)) for n in range(7)], SPEC)).collect()}
    assert out[4] == "About 4\n\nParagraph 4 with a good number of words in it.\n\nAnd one more, number 4, of words that are no link."


def test_text_of_the_template_is_no_article(table):
    pages = [(n, "http://c.example.com/", f"<article><h1>T{n}</h1><p>Own words of page {n}, quite a few of them here.</p><h5>Thank you for reading</h5></article>")
             for n in range(6)]
    assert {r.text for r in he.extract(table(pages, SPEC)).collect()} == {f"T{n}\n\nOwn words of page {n}, quite a few of them here." for n in range(6)}
    copies = [(n, "http://d.example.com/", "<article><h1>Same</h1><p>All copies of one page.</p></article>") for n in range(6)]
    assert {r.text for r in he.extract(table(copies, SPEC)).collect()} == {"Same\n\nAll copies of one page."}


def test_broken_markup(table):
    cases = {
        "<article><p>a<p>b</div></article></p>c": "a\n\nb",
        "<article>1 < 2 & 3 > 2 <p class='x>y'>q</p><p title=\"it's\">r</p></article>": "1 < 2 & 3 > 2\n\nq\n\nr",
        "<article><p>open <b>bold<br><p>next</article><footer>f": "open bold\n\nnext",
        "<article><p>kept</p><script>lost": "kept",
        "<article><p>kept</p><!-- lost <p>x</p>": "kept",
        "<article><table><tr><td>a<td>b<tr><td>c</table></article>": "a\n\nb\n\nc",
        "<article><p>x<span class=ad>Buy <span>now</span></span> y</p><p hidden>z</p></article>": "x y",
        "<": "<", "": "", "   ": "", "plain words": "plain words", "<p": "", "</p>": "", "<article></article>": "",
        "<article><p>\x00 odd ퟿ &#0; &bogus; &amp;lt;</p></article>": "\x00 odd ퟿ � &bogus; &lt;",
    }
    pages = [(n, f"http://h{n}.example.com/", html) for n, html in enumerate(cases)]
    assert [r.text for r in he.extract(table(pages, SPEC)).orderBy("page_id").collect()] == list(cases.values())


def test_edge_rows(spark, table):
    deep = "<div>" * 3000 + "<article><p>deep text</p></article>" + "</div>" * 3000
    long = "<article>" + "".join(f"<p>w{i} <h2>h{i}</h2>" if i % 3 else f"<ul><li>{i}</ul>" for i in range(30_000)) + "</article>"
    names = [c for c in CLASHING if c != "part"] + ["host", "stream", "wrapper", "parts", "salt", "text", "n_chars"]
    spec = SPEC + ", " + ", ".join(f"`{c}` string" for c in names)
    data = [(1, None, None), (2, None, "<p>x</p>"), (2, None, "<p>x</p>"), (None, "", "<p>y</p>"), (3, "not a url", ""), (4, "http://e.example.com/", deep),
            (5, "HTTP://user:pw@F.example.com:80/?q", long), (6, "http:///", "<p>z</p>")]
    out = he.extract(spark.createDataFrame([(*r, *["x"] * len(names)) for r in data], spec).repartition(3))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = rows(out.filter("page_id <> 5 or page_id is null").select("page_id", "text", "n_chars"))
    assert got == sorted([(1, "", 0), (2, "x", 1), (2, "x", 1), (None, "y", 1), (3, "", 0), (4, "deep text", 9), (6, "z", 1)], key=repr)
    text = out.filter("page_id = 5").first().text
    assert text.split("\n\n")[:5] == ["0", "w1", "h1", "w2", "h2"] and len(text.split("\n\n")) == 50_000
    assert he.extract(spark.createDataFrame([], SPEC)).count() == 0


def test_many_streams_of_one_host_give_one_wrapper(table, monkeypatch):
    """Far more kinds of pages than one task aligns, and the result does not depend on partitions."""
    monkeypatch.setattr(he, "FAN", 5)
    monkeypatch.setattr(he, "HELD", 7)
    monkeypatch.setattr(he, "SHARE", 8)
    rng = random.Random(4)
    kinds = ["<h2>s {}</h2>", "<ul><li>l {}<li>m</ul>", "<blockquote>q {}</blockquote>", "<pre>c {}</pre>", "<div class=advert>ad {}</div>", "<p>p {}</p>"]
    pages, wanted = [], {}
    for n in range(150):
        chosen = [rng.choice(kinds).format(f"{n}-{i}") for i in range(rng.randrange(1, 9))]
        pages.append((n, "http://hot.example.com/", f"<nav>menu {n}</nav><article><h1>t {n}</h1>{''.join(chosen)}</article>"))
        wanted[n] = [f"t {n}"] + [w for c in chosen if "advert" not in c for w in (
            [c[len("<ul><li>"):].split("<li>")[0], "m"] if c.startswith("<ul>") else [c.split(">", 1)[1].rsplit("<", 1)[0]])]
    source = table(pages, SPEC)
    assert he.wrappers(source.select(he.host_of(source.url).alias("host"), "html")).count() == 1
    for parts in (1, 7):
        out = {r.page_id: r.text.split("\n\n") for r in he.extract(source.repartition(parts)).collect()}
        assert out == wanted
