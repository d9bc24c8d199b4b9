"""Pages: sections, references, links, sitemaps, article sources."""

import html as std_html
from html.parser import HTMLParser
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from millrace.functions.entities import decode_entities
from millrace.functions.htmltree import MAX_DEPTH, TAGS
from millrace.functions.urls import base_url, resolve_url
from millrace.operators.extract import prose_sections
from millrace.plans import views
from millrace.sources import feeds


class Node:
    def __init__(self, name, parent=None):
        self.name, self.parent, self.children = name, parent, []
        if parent:
            parent.children.append(self)

    def text(self):
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)


HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SCOPE = {"applet", "caption", "table", "td", "th", "marquee", "object", "template", "root"}
CONTEXT = {"tr": {"tbody", "thead", "tfoot", "table"}, **{c: {"tr", "tbody", "thead", "tfoot", "table"} for c in ("td", "th")}}
CONTEXT.update({c: {"table"} for c in ("tbody", "thead", "tfoot", "caption")})
PARTS = {"tr", "td", "th", "tbody", "thead", "tfoot", "caption"}


class Walker(HTMLParser):
    """A page as a tree of nodes, then walked from the root: an independent reading."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.node = Node("root")
        self.standards = False

    def open(self):
        out, n = [], self.node
        while n:
            out.append(n)
            n = n.parent
        return out

    def found(self, names, scope):
        for n in self.open():
            if n.name in names:
                return n
            if n.name in scope:
                return None
        return None

    def close_to(self, node):
        if node:
            self.node = node.parent

    def handle_decl(self, decl):
        self.standards |= decl.lower().startswith("doctype html")

    def handle_starttag(self, tag, attrs):
        if tag not in TAGS:
            return
        if tag in PARTS:
            if not any(n.name == "table" for n in self.open()):
                return
            while self.node.name not in CONTEXT[tag]:
                self.node = self.node.parent
        elif tag == "button":
            self.close_to(self.found({"button"}, SCOPE))
        elif tag in ("applet", "marquee", "object", "template") or (tag == "table" and not self.standards):
            pass
        else:
            if tag in ("li", "dd", "dt"):
                same = {"li"} if tag == "li" else {"dd", "dt"}
                for n in self.open():
                    if n.name in same:
                        self.close_to(n)
                        break
                    if n.name not in ("address", "div", "p"):
                        break
            self.close_to(self.found({"p"}, SCOPE | {"button"}))
            if tag in HEADINGS and self.node.name in HEADINGS:
                self.node = self.node.parent
        if tag != "hr":
            self.node = Node(tag, self.node)

    def handle_endtag(self, tag):
        if tag in HEADINGS:
            self.close_to(self.found(HEADINGS, SCOPE))
        elif tag in PARTS or tag == "table":
            self.close_to(self.found({tag}, {"table"} - {tag}))
        elif tag in TAGS:
            extra = {"button"} if tag == "p" else {"ol", "ul"} if tag == "li" else set()
            self.close_to(self.found({tag}, SCOPE | extra))

    def handle_data(self, data):
        self.node.children.append(data)

    def result(self, text):
        self.feed(text)
        self.close()
        done, now = [], ["", [], []]

        def walk(node):
            nonlocal now
            if node.name in ("h1", "h2", "h3"):
                done.append(now)
                now = [node.text(), [], []]
            elif node.name in ("p", "pre") and node.text().strip():
                now[1 if node.name == "p" else 2].append(node.text().strip())
            if node.name != "pre":
                for c in node.children:
                    if not isinstance(c, str):
                        walk(c)

        walk(self.root)
        return [(title, "\n".join(prose), code) for title, prose, code in [*done, now] if prose or code]


def sections(spark, pages):
    rows = prose_sections(spark.createDataFrame(pages, "page_id bigint, html string"))
    out = {}
    for r in rows.orderBy("page_id", "section_no").collect():
        out.setdefault(r.page_id, []).append((r.title, r.prose, r.code_blocks))
    return out


ARTICLE = """<h2>Closing files</h2>
<p>Close what you open, as soon as it is open:</p>
<pre><code>f, err := os.Open(name)
if err != nil {
    return err
}
defer f.Close()</code></pre>
<p>The deferred call runs last.</p>"""


def test_article(spark):
    ((title, prose, code),) = sections(spark, [(1, ARTICLE)])[1]
    assert title == "Closing files" and prose.count("\n") == 1
    assert code == ["f, err := os.Open(name)\nif err != nil {\n    return err\n}\ndefer f.Close()"]


HARD = [
    "<p>before</p><h1>Cap</h1><h2>Pre&amp;p</h2><p>x<p>y</p>z<h3></h3><pre> </pre><h3> T </h3><pre>&lt;p&gt;\n</pre>",
    '<!-- <h1>no</h1> --><h1 class="a>b">A <b>B</b></h1><div><p title=\'x > y\'>one<br>two</div>three<p>four',
    "<script>var t = '</p><h1>';</script><p>a<script>if (a < b && c) {}</script>b</p><style>p{}</style><title><p></title>",
    "<pre class='x'><div>a</div><p>b</p>\n<span>c</span></pre><P>UP</P><h4>not a split</h4><ul><li><p>item</li></ul>",
    "<p>1 < 2 &amp;&amp; 3 &gt; 2 &copy; &nbsp;&hellip; &#8217;&#x2014;&notin; &unknown; &amp;lt;</p>",
    "<h2>T</h2><!-- open <p>x</p>",
    "<h2>T</h2><p>x</p><pre>never closed <b>y</b>",
    "text only",
    "<h1>only</h1>",
    "\x01P<p>\x02m\x03arked\x04\x05</p>",
    "<picture></picture><param><progress>no</progress><p\n>  trimmed 　</p>",
    "<p>a</p>\r\n<pre>x\r\ny\rz</pre>",
    "<h2>A <div>block <p>in it</p></div> end</h2><p>x",
    "<h2>T<pre>code</pre></h2><p>text<pre>more</pre>lost<p>end",
    "<p>a<table><tr><td><p>b</p><td>c<tr><th>d<p>e</table>f</p>g",
    "<!DOCTYPE html><p>a<table><tr><td><p>b</p><td>c<tr><th>d<p>e</table>f</p>g",
    "<div><p>one</div>two<p>three<section>four<p>five</section>six</div><p>seven",
    "<ul><li><p>a<li>b<ul><li><p>c</ul><p>d</ul><p>e<dl><dt><p>f<dd>g<p>h</dl>i",
    "<p>a<button>b<p>c</p>d</button>e</p>f<p>g<object>h<p>i</object>j</p>k",
    "<pre>a<h2>no</h2><p>no</p>b</pre><h1>A<h2>B</h1>c<p>d",
    "<p>td <td>outside<tr>of tables</p></table><p>x</td>y",
    "<table><caption><p>c</p><tr><td><table><tr><td><p>in</table>out<p>z</table><p>after",
    "<h2>\x01H\x06t</h2><pre>\x05&amp;\x04<b>\x02\x03</pre><p>&#1;&#2;&#6;x\x061",
    "<p>x" + "<div>" * 30 + "<p>deep" + "</div>" * 31 + "<p>y",
]


def test_hard_pages(spark):
    found = sections(spark, list(enumerate(HARD)))
    for i, text in enumerate(HARD):
        plain = text.replace("\r\n", "\n").replace("\r", "\n")
        # The standard library drops references to control characters.
        plain = plain.replace("&#1;", "\x01").replace("&#2;", "\x02").replace("&#6;", "\x06")
        assert found.get(i, []) == Walker().result(plain), text
    assert found[2] == [("", "aif (a < b && c) {}b", [])]


def test_all_pages_like_the_walker(spark):
    pages = views.articles(spark, SF_DIR).collect()
    found = sections(spark, [(p.page_id, p.html) for p in pages])
    for p in pages:
        assert found[p.page_id] == Walker().result(p.html)
        assert len(found[p.page_id]) >= 1


def test_nesting_is_followed_to_a_bound(spark):
    page = "<p>x" + "<div>" * (MAX_DEPTH + 50) + "<p>deep</p>" * 3 + "</div>" * (MAX_DEPTH + 50) + "<p>y"
    assert sections(spark, [(1, page)])[1] == [("", "x\ny", [])]


@pytest.mark.parametrize("tag", ["<p>", "<div>", "<h4>", "<table><td>", "</div>", "<li>"])
def test_many_tags_take_linear_time(spark, tag):
    assert sections(spark, [(1, "<h2>T</h2><pre>kept</pre>" + tag * 20_000)])[1] == [("T", "", ["kept"])]


def test_links_keep_every_character(spark):
    pages = [(1, "http://site.example/", '<a href="/a?&#1;=\x02">1</a><a href="/b">\x03</a>')]
    links = feeds.discover_links(spark.createDataFrame(pages, "page_id int, url string, html string")).collect()
    assert [r.link for r in links] == ["http://site.example/b"]  # control characters are no part of an address


def test_references(spark):
    names = ["&amp;", "&AMP", "&ampx;", "&notit;", "&notin;", "&#65;", "&#x41;", "&#X41", "&#0;", "&#128;", "&#150;",
             "&#xD800;", "&#x110000;", "&#99999999999999999999;", "&#xFFFFFFFFFFFFFFFFFFFFF;", "&;", "&", "&&amp;&",
             "&fjlig;", "&NotEqualTilde;", "&#;", "&#x;", "&#38;lt;", "&ngE;", "a&lt b", "&copy2020", "&COPY;&eacute", "&#129;", "&#000000000065;", "&#x;", "&#00;", "&#x0000000000041;"]
    rows = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "s string, i int")
    for r in rows.select("s", decode_entities(F.col("s")).alias("d")).collect():
        want = std_html.unescape(r.s)
        assert r.d == ("\x81" if r.s == "&#129;" else want), r.s
    attribute = decode_entities(F.lit("/a?x=1&copy=2&amp;y&lt"), in_attribute=True)
    assert rows.select(attribute.alias("d")).first().d == "/a?x=1&copy=2&y<"


BASES = ["http://h.example/a/b/c?q=1#f", "https://u:p@H.example:8080/x/", "http://h.example", "http://h.example/für/x"]
HREFS = ["/r", "r", "./r", "../r", "../../../r", "r/./s/../t", "..", ".", "r/..", "r/.", "?z=1", "#g", "r#h", "r?y#z",
         "/a//b", "//o.example/z", "https://o.example", "/a?b=/../c", "a/b:c", "/c:d", "r;p=1"]


def test_resolution_like_urljoin(spark):
    pairs = [(b, h) for b in BASES[:3] for h in HREFS]
    frame = spark.createDataFrame(pairs, "b string, h string")
    for r in frame.select("b", "h", resolve_url(base_url(F.col("b")), F.col("h")).alias("u")).collect():
        base = r.b if r.b.count("/") > 2 else r.b + "/"
        want = urljoin(base, r.h)
        if r.h in ("?z=1", "#g") and base != r.b:  # an empty path stays empty
            want = r.b + r.h
        assert r.u == want, (r.b, r.h)


@pytest.mark.parametrize(
    "base, href, want",
    [
        (BASES[0], "", "http://h.example/a/b/c?q=1#f"),
        (BASES[0], "HTTP://H.example/q/../w", "http://H.example/w"),
        (BASES[0], "?", "http://h.example/a/b/c?"),
        (BASES[0], "mailto:a@b.example", None),
        (BASES[0], ":x", None),
        (BASES[0], "a:b/c", None),
        (BASES[0], "1a:b", None),
        (BASES[0], "/%zz", None),
        (BASES[0], "/50%", None),
        (BASES[0], "/a\tb", None),
        (BASES[0], "/für", "http://h.example/f%C3%BCr"),
        (BASES[0], "/a b+(c)*", "http://h.example/a%20b+%28c%29%2A"),
        (BASES[0], "/(c)*'!", "http://h.example/(c)*'!"),
        (BASES[0], "/%41ü", "http://h.example/A%C3%BC"),
        (BASES[0], "/x?ü=ü#ü(1)", "http://h.example/x?ü=ü#%C3%BC(1)"),
        (BASES[3], "y", "http://h.example/f%C3%BCr/y"),
    ],
)
def test_resolution_cases(spark, base, href, want):
    frame = spark.createDataFrame([(base, href)], "b string, h string")
    assert frame.select(resolve_url(base_url(F.col("b")), F.col("h")).alias("u")).first().u == want


def test_links_of_an_index_page(spark):
    html = """<a href="/notes/a">1</a><a href="/notes/b">2</a><a href="/notes/a">again</a>
    <a href="three?a=1&amp;b=2">3</a><a href="https://other.example/x">no</a><a HREF='http://site.example.evil/y'>yes</a>
    <a name="x">none</a><a data-href="/no" title="href=/no">none</a><A class=k href=/bare>4</A><a href>self</a>
    <!-- <a href="/hidden"> --><script>'<a href="/js">'</script><abbr href="/no2"></abbr><a href="javascript:x()">js</a>"""
    pages = spark.createDataFrame([(1, "http://site.example/index", html)], "page_id int, url string, html string")
    rows = feeds.discover_links(pages).orderBy("pos").collect()
    assert [r.link for r in rows] == [
        "http://site.example/notes/a", "http://site.example/notes/b", "http://site.example/three?a=1&b=2",
        "http://site.example.evil/y", "http://site.example/bare", "http://site.example/index",
    ]
    assert [r.pos for r in rows] == list(range(6))


def test_sitemaps(spark):
    good = """<?xml version="1.0" encoding="UTF-8"?>
<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">
  <url><loc>https://s.example/one</loc></url><url><lastmod>x</lastmod></url>
  <url><loc>https://s.example/two?a=1&amp;b=2</loc></url><url><loc></loc></url>
</urlset>"""
    rows = [("a", good), ("bad", "<urlset><url>"), ("text", "not xml"), ("empty", "<urlset></urlset>")]
    out = feeds.sitemap_urls(spark.createDataFrame(rows, "url string, body string")).orderBy("url", "pos").collect()
    assert [(r.url, r.pos, r.loc, r.error) for r in out] == [
        ("a", 0, "https://s.example/one", None), ("a", 1, "https://s.example/two?a=1&b=2", None),
        ("bad", 0, None, "sitemap is not well-formed"), ("text", 0, None, "sitemap is not well-formed"),
    ]


def test_article_sources(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    catalog = frame(
        [(1, "http://a.example/one", "", "single_page"), (2, "http://a.example/missing", "", "single_page"),
         (3, "", "good.txt", "url_list"), (4, "", "bad.txt", "url_list"), (5, "http://a.example/", "", "blog_index"),
         (6, "http://none.example/", "", "blog_index"), (7, "http://a.example", "", "sitemap"),
         (8, "http://b.example", "", "sitemap"), (9, "repo", "", "markdown_repo"), (10, "x", "", "podcast"),
         (11, "http://c.example", "", "sitemap"), (12, "", "lost.txt", "url_list"),
         (13, "lost", "", "markdown_repo"), (14, "y", "", None), (15, None, "", "podcast")],
        "source_id int, url string, path string, type string",
    )
    index = '<a href="/one">1</a><a href="/gone">2</a><a href="/two">3</a>'
    pages = frame([("http://a.example/one", "P1"), ("http://a.example/two", "P2"), ("http://a.example/", index)],
                  "url string, html string")
    lists = frame([("good.txt", 0, "http://a.example/two"), ("good.txt", 1, "http://a.example/one"),
                   ("bad.txt", 0, "http://a.example/one"), ("bad.txt", 1, "http://a.example/no1"),
                   ("bad.txt", 2, "http://a.example/no2")], "path string, pos long, url string")
    sitemaps = frame([("http://a.example/sitemap.xml",
                       "<urlset><url><loc>http://a.example/gone</loc></url><url><loc>http://a.example/one</loc></url></urlset>"),
                      ("http://c.example/sitemap.xml", "<urlset>")], "url string, body string")
    markdown = frame([("repo", 0, "# A"), ("repo", 1, "# B"), ("unlisted", 0, "# C")], "repo_url string, pos long, content string")
    out = feeds.article_dispatch(catalog, pages, lists, sitemaps, markdown)
    rows = sorted((r.source_id, r.pos, r.url, r.content, r.error) for r in out.collect())
    assert rows == [
        (1, 0, "http://a.example/one", "P1", None),
        (2, 0, "http://a.example/missing", None, "no page at http://a.example/missing"),
        (3, 0, "http://a.example/two", "P2", None), (3, 1, "http://a.example/one", "P1", None),
        (4, 1, "http://a.example/no1", None, "no page at http://a.example/no1"),
        (5, 0, "http://a.example/one", "P1", None), (5, 2, "http://a.example/two", "P2", None),
        (6, 0, "http://none.example/", None, "no page at http://none.example/"),
        (7, 1, "http://a.example/one", "P1", None),
        (8, 0, "http://b.example/sitemap.xml", None, "no page at http://b.example/sitemap.xml"),
        (9, 0, "repo", "# A", None), (9, 1, "repo", "# B", None),
        (10, 0, "x", None, "no such kind of source: podcast"),
        (11, 0, None, None, "sitemap is not well-formed"),
        (12, 0, "lost.txt", None, "no address list at lost.txt"), (13, 0, "lost", None, "no documents at lost"),
        (14, 0, "y", None, "no such kind of source: "), (15, 0, None, None, "no such kind of source: podcast"),
    ]


@pytest.mark.parametrize("unclosed", ["<p ", "<a ", "<h1 ", "<title ", "<pre ", "<script x='", '<div "'])
def test_broken_pages_take_linear_time(spark, unclosed):
    html = "<h2>T</h2><p>kept</p>" + unclosed * 300_000
    assert sections(spark, [(1, html)])[1] == [("T", "kept", [])]
    pages = spark.createDataFrame([(1, "http://site.example/", html)], "page_id int, url string, html string")
    assert feeds.discover_links(pages).count() == 0
