import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

import docketflow as d
from docketflow.functions import html

DROPPED = {"script", "style", "header", "footer", "nav", "noscript"}


class Walker(HTMLParser):
    """An independent reading of a page: text outside dropped elements, by node."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.body, self.done = None, False, False
        self.everything, self.in_body = [], []

    def handle_starttag(self, tag, attrs):
        self.everything.append("\n")
        self.in_body.append("\n")
        if self.hidden is None and tag in DROPPED:
            self.hidden = tag
        elif tag == "body" and self.hidden is None and not self.body:
            self.body, self.in_body = True, []

    def handle_endtag(self, tag):
        self.everything.append("\n")
        self.in_body.append("\n")
        if tag == self.hidden:
            self.hidden = None
        elif tag in ("body", "html") and self.hidden is None:
            self.done = self.body

    def handle_comment(self, data):
        self.handle_data("\n")

    def handle_pi(self, data):
        self.handle_data("\n")

    def handle_decl(self, decl):
        self.handle_data("\n")

    def unknown_decl(self, data):
        self.handle_data("\n" + data.removeprefix("CDATA[") + "\n")

    def handle_data(self, data):
        if self.hidden is None:
            self.everything.append(data)
            if self.body and not self.done:
                self.in_body.append(data)

    def text(self):
        raw = "".join(self.in_body if self.body else self.everything)
        return "\n".join(s for s in (line.strip() for line in raw.splitlines()) if s)


def walk(page):
    walker = Walker()
    walker.feed(page)
    walker.close()
    return walker.text()


def clean(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    return [r.cleaned_text for r in d.clean_pages(df).orderBy("i").collect()]


CASES = {
    "<body>Hello <b>World</b>!</body>": "Hello\nWorld\n!",
    "<p>no body&nbsp;</p>": "no body",
    "<body>a<!-- <script> -->b</body>": "a\nb",
    "<body><script><!-- x </script>c<!-- y -->d</body>": "c\nd",
    "<body>x &lt;b&gt; &amp;lt; &#8217;</body>": "x <b> &lt; ’",
    "<body>one<p>1 < 2</body><body>two</body>": "one\n1 < 2",
    "<body>a<a title='x>y'>z</a></body>": "a\nz",
    "<body>a&ampb &amp, c</body>": "a&ampb &, c",
    "<body>&#146;&#x93;&#150; &#x1F600; &#0065;</body>": "’“– 😀 A",
    "<body>&#xD800;&#99999999999999999999;&#x110000;</body>": "���",
    "<body>a&#10;b&#x2028;c</body>": "a\nb\nc",
    "<body>&eacute;&Eacute;&notaname; R&D</body>": "éÉ&notaname R&D",
    "<?xml version='1.0'?><html>t</html>": "t",
    "<title>T</title><BODY class=x>u<NAV>v</NAV>w</BODY>after": "u\nw",
    "<body><nav/>kept<navy>too</navy></body>": "kept\ntoo",
    "<body>open <style>p{}": "open",
    "<title>T</title>a</body>b": "T\na\nb",
    "<html><body>a</html>b": "a",
    "<body></body>x": "",
    "a<img alt=\"<nav>\">b<i title='</i>'>c": "a\nb\nc",
    "a<i data-x=it's>b<p<!-- c -->d": "a\nb\nd",
    "a<nav title='>'>n<!-- </nav> --><b x='</nav>'><script>'</nav>'</script>m</nav >z": "a\nz",
    "<body>a<![CDATA[ lit &amp; ]]>b<!-- <body> --><script>'<body>'</script>": "a\nlit &\nb",
    "a<!DOCTYPE x \"y>z": "a\nz",
    "a</ p>b</>c</p x='>'>d": "a\nb\nc\n'>d",
    "": "",
}


def test_hand_written_pages(spark):
    assert clean(spark, list(CASES)) == list(CASES.values())


PIECES = [
    "a", "b ", "  ", "\n", "x y", "&amp;", "&lt;", "&nbsp;", "&#65;", "&", "<b>", "</b>", "<br/>",
    "<p class='x>y'>", "<a href=\"q>r\">", "</a>", "<!-- c -->", "<!-- <b> -->", "<!DOCTYPE html>",
    "<?xml v?>", "<script>var a='<b>';</script>", "<style>p{}</style >", "<NAV x=1>n</NAV>",
    "<header>h</header>", "<meta charset=u>", "<body>", "</body>", "<BODY a='b'>", "<html>",
    "</html>", "< 3", "<3", "a<b", "</", "<>", "</ p>", "\x0b", "\x85", "\u2028", "<title>t</title>",
    "<footer\n>f</footer>", "<noscript>n<b>m</b></noscript>", "<script src=x></script>",
    "<div data-x=a'b>", "<img alt=\"<nav>\">", "<!>", "<textarea><b>z</b></textarea>",
]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_markup_equals_independent_walk(spark, seed):
    rng = random.Random(seed)
    pages = ["".join(rng.choices(PIECES, k=rng.randint(1, 9))) for _ in range(4000)]
    wrong = [(p, t) for p, t in zip(pages, clean(spark, pages)) if t != walk(p)]
    assert wrong == []


def test_null_page(spark):
    df = spark.createDataFrame([(None,)], "html string")
    assert d.clean_pages(df).collect()[0].cleaned_text is None


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.01"])
def test_whole_table_equals_independent_walk(spark, sf_dir):
    pages = d.clean_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()
    assert len(pages) > 100
    assert [r.page_id for r in pages if r.cleaned_text != walk(r.html)] == []


def test_long_tags_and_unbalanced_quotes_do_not_overflow(spark):
    long_tag = "<a " + "x=y " * 200_000 + ">t</a>"
    unbalanced = "<body>" + "<p title=\"" + "z" * 300_000 + "</body>"
    comment = "<body>" + "<!-- " + "q " * 300_000 + "-->end</body>"
    quotes = "<p " + "a='1' " * 200_000 + ">q</p>"
    script = "<body>s<script>" + "a<b; " * 200_000 + "</script>t<!--" + "-- > " * 200_000 + "-->u</body>"
    got = clean(spark, [long_tag, unbalanced, comment, quotes, script])
    assert got[0] == "t" and got[2] == "end" and len(got[1]) > 300_000
    assert got[3:] == ["q", "s\nt\nu"]
    rows = "<tr>" + "<td>x<i></i></td>" * 50_000
    assert pick(spark, [table(rows, row("/a.htm", "10-K"))], "A") == [(True, "/a.htm")]


def pick(spark, pages, rule):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    rows = d.pick_document(df, rule=rule).orderBy("i").collect()
    return [(r.has_table, r.href) for r in rows]


def table(*rows, cls="tableFile"):
    return f'<table summary="x" class="{cls}"><tr><th>h</th></tr>{"".join(rows)}</table>'


def row(href, kind, extra=""):
    return f'<tr><td>1</td><td>d</td><td><a href="{href}">f</a>{extra}</td><td>{kind}</td></tr>'


LINK_PAGES = [
    (table(row("/a.htm", "EX-1"), row("/b.htm", " 10-k ")), "/b.htm", "/a.htm"),
    (table(row("/a-index.htm", "10-K"), row("/c.HTM", "10-K/A")), "/c.HTM", None),
    (table(row("/a.html", "10-K"), row("/d.htm", "8-K")), "/d.htm", "/a.html"),
    # The first link of a row decides; the fall-back looks at every link.
    (table(row("/a.pdf", "10-K", '<a href="/e.htm">x</a>')), "/e.htm", "/e.htm"),
    # The first row is passed over, but its links count for the fall-back.
    (f'<table class=tableFile>{row("/f.htm", "10-K")}{row("/g.htm", "EX")}</table>', "/f.htm", "/f.htm"),
    (table(row("/h.htm?a=1&amp;b=.htm", "<b>10</b>-K")), "/h.htm?a=1&b=.htm", "/h.htm?a=1&b=.htm"),
    (table(row("/myindex/x.htm", "10-K")), "/myindex/x.htm", None),
    (table("<tr><td>1</td><td><a href='/i.htm'>f</a></td><td>10-K</td></tr>", row("/j.htm", "10-K")),
     "/j.htm", "/i.htm"),
    ("<!-- " + table(row("/k.htm", "10-K")) + " -->" + table(row("/l.htm", "10-K")), "/l.htm", "/l.htm"),
]


def test_primary_links(spark):
    pages = [p for p, _, _ in LINK_PAGES]
    assert pick(spark, pages, "A") == [(True, a) for _, a, _ in LINK_PAGES]
    assert pick(spark, pages, "B") == [(True, b) for _, _, b in LINK_PAGES]


class TableWalker(HTMLParser):
    """An independent reading of the document table: rows of cells, and links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.state, self.rows, self.links, self.cell = "before", [], [], None

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag == "table" and self.state == "before":
            if "tableFile" in (attrs.get("class") or "").split():
                self.state = "in"
        elif self.state == "in":
            self.cell = None if tag in ("tr", "td", "th") else self.cell
            if tag == "tr":
                self.rows.append(([], []))
            elif tag == "td":
                self.cell = [""]
                self.rows[-1][0].append(self.cell)
            elif self.cell:
                self.cell.append("")
            if tag == "a" and "href" in attrs:
                self.links.append(attrs["href"] or "")
                self.rows[-1][1].append(attrs["href"] or "")

    def handle_endtag(self, tag):
        if self.state == "in":
            if tag == "table":
                self.state = "after"
            elif tag in ("td", "tr"):
                self.cell = None
            elif self.cell:
                self.cell.append("")

    def handle_data(self, data):
        if self.state == "in" and self.cell:
            self.cell[-1] += data

    def pick(self, rule):
        def page(h):
            return h.lower().endswith(".htm") and not h.lower().endswith("-index.htm")

        if rule == "B":
            found = [h for h in self.links if h.endswith((".htm", ".html")) and "index" not in h.lower()]
            return found[0] if found else None
        for cells, links in self.rows[1:]:
            if len(cells) >= 4 and links and page(links[0]):
                if "".join(t.strip() for t in cells[3]).upper() in ("10-K", "10-K/A"):
                    return links[0]
        return next((h for h in self.links if page(h)), None)


def random_index_page(rng):
    def link():
        ext = rng.choice([".htm", ".HTM", ".html", "-index.htm", ".pdf", ".htm?x=1&amp;y=2", "&#46;htm", ""])
        href = f"/d{rng.randint(0, 9)}{rng.choice(['', '', '/index/', 'é'])}{ext}"
        attr = rng.choice([f'href="{href}"', f"HREF='{href}'", f"href = {href}" if ext else "href='x'",
                           f'title="a > b" href="{href}"', f'data-href="/no.htm" href="{href}"', "name=x"])
        return f"<{rng.choice('aA')} {attr}>{rng.choice(['f', '<b>f</b>'])}</a>"

    def cell(text):
        return f"<td{rng.choice(['', ' scope=row', ' class=x nowrap'])}>{text}</td>"

    def table_row():
        kind = rng.choice(["10-K", " 10-k/a ", "10-K405", "&nbsp;10-K", "<b>10</b>-K<br>", "EX-1", "10 -K", ""])
        cells = [cell("1"), cell("d"), cell("".join(link() for _ in range(rng.choice([0, 1, 1, 2])))), cell(kind)]
        cells = cells[: rng.choice([4, 4, 4, 3])] + [cell("size")] * rng.choice([0, 1])
        return f"<{rng.choice(['tr', 'TR class=even'])}>{rng.choice(['', chr(10)]).join(cells)}</tr>"

    opening = rng.choice(['<table class="tableFile">', "<TABLE summary='x' class='a tableFile b' >",
                          "<table class=tableFile>", "<table class='tableFiles'>", "<table id=tableFile>"])
    rows = "".join(table_row() for _ in range(rng.randint(0, 4)))
    hidden = rng.choice(["", "<!-- <table class='tableFile'><tr></tr></table> -->",
                         "<script>'<table class=\"tableFile\">'</script>"])
    return f"<html>{hidden}{link()}{opening}\n{rows}</table>{link()}</html>"


@pytest.mark.parametrize("rule", ["A", "B"])
def test_random_index_pages_equal_independent_walk(spark, rule):
    rng = random.Random(rule)
    pages = [random_index_page(rng) for _ in range(3000)]
    expected = []
    for text in pages:
        walker = TableWalker()
        walker.feed(text)
        walker.close()
        expected.append((walker.state != "before", walker.pick(rule)))
    got = pick(spark, pages, rule)
    assert [(p, g, e) for p, g, e in zip(pages, got, expected) if g != e][:3] == []
    assert sum(e[1] is not None for e in expected) > 500


def test_pages_without_document_table(spark):
    pages = [table(row("/a.htm", "10-K"), cls="tableFiles"), "<p>moved</p>", "", None]
    for rule in "AB":
        assert pick(spark, pages, rule) == [(False, None)] * 4
    assert pick(spark, [table(cls="x tableFile y")], "B") == [(True, None)]


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("x",)], "html string")
    for out in (d.clean_pages(df), d.pick_document(df, rule="A")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Exchange" not in plan


def test_filters_do_not_repeat_the_cleaning(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    kept = d.clean_pages(pages).filter(F.length("cleaned_text") > 3).select("page_id")
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("array_join(filter") == 1


def test_elements_inside_others_of_their_name(spark):
    pages = [
        "<body>a<nav>x<nav>y</nav>z</nav>b</body>", "<body><header><header><header>1</header>2</header>3</header>c</body>",
        "<body>a<nav>x<script>'</nav>'</script><nav>y</nav>z", "<body>p<nav>q<b>r</b></nav>s",
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    got = [r.cleaned_text for r in d.clean_pages(df).orderBy("i").collect()]
    assert got == ["a\nb", "c", "a", "p\ns"]


def test_tables_inside_the_document_table(spark):
    page = (
        '<table class="tableFile"><tr><th>h<table><tr><td>n</td></tr></table></th></tr>'
        "<tr><td>1</td><td>t</td><td><a href='/d.htm'>d</a></td><td>10-K</td></tr></table><a href=/late.htm>l</a>"
    )
    df = spark.createDataFrame([(page,)], "html string")
    for rule in "AB":
        r = d.pick_document(df, rule=rule).first()
        assert (r.href, r.has_table) == ("/d.htm", True)


def test_elements_at_any_depth(spark):
    for n in (5, 6, 7, 200, 3000):
        nest = "<nav a='</nav>'>x" * n + "y</nav>z" * n
        pages = [f"<body>a{nest[:-1]}b</body>", "<body>a" + "<nav>x" * n + "</nav>" * (n - 1) + "b</body>", "<nav>n</nav>t " * n]
        assert clean(spark, pages) == ["a\nb", "a", "\n".join(["t"] * n)]


def test_other_names_inside_a_dropped_element_do_not_close_it(spark):
    pages = ["a<nav>x<footer>y</nav>b</footer>c", "a<header><nav>x</header>b<nav>y", "a</nav>b<nav/>c<nav>d</header>e</nav >f"]
    assert clean(spark, pages) == [walk(p) for p in pages] == ["a\nb\nc", "a\nb", "a\nb\nc\nf"]


def nested(n, cell=""):
    return "<table><tr><td>n" * n + cell + "</td></tr></table>" * n


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 8, 100])
def test_tables_at_any_depth(spark, n):
    other = row("/late.htm", "10-K")
    link = "<a href='/d.htm'>d</a>"
    in_head = f"<table class=tableFile><tr><th>h{nested(n)}</th></tr>{row('/d.htm', '10-K')}</table>{other}"
    in_cell = table(f"<tr><td>1</td><td>{link}</td><td>{nested(n)}</td><td>10-K</td></tr>", other)
    pages = [in_head, in_cell]
    # Cells of inner tables count: the fourth of this row is one of them when there are three.
    inner = table(f"<tr><td>{link}</td><td>{'<table><tr><td>n</td><td>10-K</td></tr></table>'}</td></tr>", other)
    assert pick(spark, [inner], "A") == [(True, "/d.htm")]
    # In the second page the fourth cell is inside the third one as soon as a table is there.
    assert pick(spark, pages, "A") == [(True, "/d.htm"), (True, "/late.htm")]
    assert pick(spark, pages, "B") == [(True, "/d.htm")] * 2
    # The first link of a row may be inside a table in it, and so may a whole row.
    deep = table(f"<tr><td>1</td><td>2</td><td>{nested(n, link)}</td></tr>")
    whole = table("<tr><td>" + nested(n, f"<table>{row('/w.htm', '10-K')}</table>") + "</td></tr>", other)
    assert pick(spark, [deep, whole], "B") == [(True, "/d.htm"), (True, "/w.htm")]
    assert pick(spark, [whole], "A") == [(True, "/w.htm")]


def test_patterns_and_walk_agree(spark, monkeypatch):
    """The same pages, read by patterns and by the walk alone."""
    rng = random.Random(9)
    pages = [random_index_page(rng).replace("</td>", nested(rng.randint(0, 3)) + "</td>", 1) for _ in range(400)]
    for rule in "AB":
        both = pick(spark, pages, rule)
        monkeypatch.setattr(html, "_FLAT_TABLE", "(no such table)")
        assert pick(spark, pages, rule) == both
        monkeypatch.undo()


def test_unclosed_tables_rows_and_cells(spark):
    link = "<a href='/d.htm'>d</a>"
    pages = [
        f"<table class=tableFile><tr><th>h<tr><td>1<td>2<td>{link}<td>10-K",
        f"<table class=tableFile><tr><th>h</tr><tr><td>1</td><td><table><tr><td>x</table></td><td>{link}</td><td>EX</td></tr>",
        f"</table></tr><table class=tableFile><tr></tr></tr><td>{link}</table>{row('/no.htm', '10-K')}",
    ]
    for rule in "AB":
        assert pick(spark, pages, rule) == [(True, "/d.htm")] * 3


@pytest.mark.parametrize("rule", ["A", "B"])
def test_tables_inside_each_other_read_alike_by_patterns_and_by_a_walk(spark, monkeypatch, rule):
    def page(depth):
        inner = "<table><tr><td>n<a href='/i.txt'>i</a>" * depth + "</td></tr></table>" * depth
        return (
            "<table class='tableFile'><tr><th>Seq</th></tr><tr><td>1</td><td>" + inner + "<a href='/x.htm'>x</a></td>"
            "<td>b</td><td>10-K</td></tr><tr><td>2</td><td><a href='/y.htm'>y</a></td><td>b</td><td>10-K</td></tr></table>"
        )

    pages = spark.createDataFrame([(n, page(n)) for n in range(16)], "n int, html string")
    by_pattern = F.regexp_extract("html", html._FLAT_TABLE, 1) != ""
    assert {r.n for r in pages.where(by_pattern).collect()} == set(range(html._FLAT + 1)) >= set(range(9))
    got = {r.n: (r.href, r.has_table) for r in html.with_primary_link(pages, "html", rule).collect()}
    monkeypatch.setattr(html, "_FLAT_TABLE", "(no such table)")
    assert got == {r.n: (r.href, r.has_table) for r in html.with_primary_link(pages, "html", rule).collect()}


PLAIN_PAGES = [
    (table(row("/a.htm", "EX-1"), row("/b.htm", "<b>10</b>-k&nbsp;/A")), "/a.htm"),
    (table(row("/a.htm", "EX-1"), row("/b.htm", "\xa0<b>10</b>-k <br/>/A&nbsp;")), "/b.htm"),
    (table(row("/a.htm", "EX-1"), row("/b.htm", "&#49;0-K")), "/b.htm"),
    (table(row("/a.htm", "10-K&NBSP;"), row("/b.pdf", "10-K"), row("/c-INDEX.htm", "10-K")), "/a.htm"),
    (table(row("/a.pdf", "10-K"), row("/b.HTM", "EX", "<a href=/c.htm>c</a>"), row("/d.htm", "10-K")), "/d.htm"),
    (table(nested(3), row("/a.htm", "EX"), f"<tr><td>{nested(8)}</td></tr>", row("/b.htm", "10-K")), "/b.htm"),
    (table(row("/a.txt", "10-K"), f"<tr><td>{nested(2, '<a href=/i.htm>i</a>')}</td></tr>"), "/i.htm"),
    (table(row("/a.htm", "EX"), "<tr><td>1<td>2<td><a href='/b.htm'>b</a><td>10-K"), "/b.htm"),
    (table(row("/a.htm", "EX"), "<tr><td>1<td>2<td><a href=/b.htm"), "/a.htm"),
    (table(row("/a.pdf", "EX"), '<tr><td><a title="<a href=/b.htm>" href="/c.pdf"></a></td></tr>'), None),
    (table(row("", "10-K"), '<tr><td><a title="<b>" href=""></a><a href="/d.htm"></a></td></tr>'), "/d.htm"),
    (table(row("/a.pdf", "10-K"), row("/b.txt", "10-K")), None),
]


def test_tables_of_plain_markup_read_alike_at_once_and_by_rows(spark, monkeypatch):
    pages = [p for p, _ in PLAIN_PAGES]
    rng = random.Random(5)
    pages += [random_index_page(rng).replace("</td>", nested(rng.randint(0, 2)) + "</td>", 1) for _ in range(600)]
    at_once = pick(spark, pages, "A")
    assert at_once[: len(PLAIN_PAGES)] == [(True, href) for _, href in PLAIN_PAGES]
    # Every row is one that might be of an annual form, so that all tables are read by rows.
    monkeypatch.setattr(html, "_FIRST_ROW", r"([\s\S])")
    assert at_once == pick(spark, pages, "A")


def test_most_tables_are_read_at_once(spark):
    """Rows and cells are taken out one by one only where the markup asks for it."""
    plain = [table(nested(8), row("/a.htm", "EX-1"), *[row(f"/{n}.pdf", "10-K&nbsp;") for n in range(3)]) for _ in range(3)]
    plain += [table(row("/a.htm", "EX-1"), row("/b.htm", " <b>10</b>-K")), table(row("/a.pdf", "10-K"))]
    df = spark.createDataFrame([(p,) for p in plain + [table(row("/a&#46;htm", "10-K"))]], "html string")
    flat = df.select(F.regexp_extract("html", html._FLAT_TABLE, 1).alias("flat"))
    read, _, known, _ = html._with_plain_choice(flat, "flat", "href")
    assert [r.known for r in read.select(F.coalesce(known, F.lit(False)).alias("known")).collect()] == [True] * 5 + [False]
