import itertools
import random
import re
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldloom.llm import html_text as h


class Plain(HTMLParser):
    """All words outside of elements that are not visible."""

    def __init__(self):
        super().__init__()
        self.hidden, self.words = [], []

    def handle_starttag(self, tag, attrs):
        if tag in ("head", "script", "style", "title", "template", "noscript"):
            self.hidden.append(tag)

    def handle_endtag(self, tag):
        if self.hidden and tag == self.hidden[-1]:
            self.hidden.pop()

    def handle_data(self, data):
        if not self.hidden:
            self.words.append(data)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, None),
        ("", ""),
        ("<p>One<p>Two <b>bo</b>ld\n x<ul><li>a<li>b<ol start=9><li>x<br>w<li>y</ol></ul>tail", "One\n\nTwo bold x\n\n- a\n- b\n  9. x\n     w\n  10. y\n\ntail"),
        ("<table><caption>Cap</caption><tr><th>Name<th>Qty<tr><td>Apple<td>3<tr><td colspan=2>All<tr><td rowspan=2>tall<td>1<tr><td>2</table>after", "Cap\nName   Qty\nApple  3\nAll\ntall   1\n       2\n\nafter"),
        ("<table><td>a<td><table><td>in<td>ner<tr><td>x</table><td>c</table>", "a  in  ner  c\n   x"),
        ("<table><tr><td>中文<td>b<tr><td>1<td>2</table>", "中文  b\n1     2"),
        ("<pre>a\n  b &lt;\n\nc</pre>x<br>y<br><br>z", "a\n  b <\n\nc\n\nx\ny\n\nz"),
        ("<div hidden>n</div><p style='display: none'>n</p><style>.h{color:red;display:none}</style><p class='x h'>n<p>yes<details><summary>S</summary>n</details><p style='visibility:hidden'>n<b style='visibility:visible'>v</b>", "yes\n\nS\n\nv"),
        ("<head><title>t</title><body>x<script>a<b</script><!-- c -->y<textarea>&amp;</textarea>", "xy&"),
        ("a < b & c &eacute; </nothing> <unclosed", "a < b & c é"),
        ("<td>loose <b><i>x</b>y</i></p>z<div>d</div></div>e", "loose xy\n\nz\nd\ne"),
        ("<select><option>1<option>2</select><blockquote>q</blockquote><dl><dt>t<dd>d</dl>", "1\n2\n\n  q\n\nt\n  d"),
    ],
)
def test_pages(page, text):
    assert h.render(page) == text


def test_all_visible_words_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = h.extract(pages, keep=["page_id"]).collect()
    source = {r.page_id: r.html for r in pages.collect()}
    assert len(got) == len(source)
    for r in got:
        plain = Plain()
        plain.feed(source[r.page_id])
        want = "".join(re.sub(r"\s", "", w) for w in plain.words)
        own = re.sub(r"(?m)^ *(?:- |\d+\. )", "", r.text)
        assert re.sub(r"\s", "", own) == want, r.page_id


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("<p> <div> </div> <table> <tr> <td> </td> </table> <ul> <li> </ul> </li> <b> </b> <pre> </pre> <h1> </h1> w x <br> <td rowspan=3> <td colspan=2> </p> <details> <summary> </details> <select> <option> </select> <caption> <li value=3> <!-- </head> <style> &amp; <q>".split()), max_size=40))
def test_any_tags_in_any_order(parts):
    h.render("".join(parts))


def test_edges(spark):
    deep = "<div>" * 50_000 + "x" + "<table><td>" * 300 + "y"
    quotes = "<a href='" * 3000
    rows = [(1, None, "k"), (1, None, "k"), (2, "", None), (None, deep, "k"), (3, "<p>" + "word " * 300_000, "k"), (4, quotes, "k")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = h.extract(pages).collect()
    assert len(got) == 6 and got[0].text is None and got[2].text == "" and got[4].text.count("word") == 300_000
    assert re.sub(r"\s", "", got[3].text) == "xy"
    assert h.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("css", "body", "text"),
    [
        ("@media print{.nav{display:none}}", "<p class=nav>n", "n"),
        ("@media screen and (max-width: 600px){.nav{display:none}} @media (min-width:600px){.m{display:none}}", "<p class=nav>n<p class=m>m", "n"),
        (".desk{display:none} .desk{display:block}", "<p class=desk>d", "d"),
        ("#a{display:block} p{display:none}", "<p id=a>a<p>b", "a"),
        ("p{display:none!important} #a{display:block}", "<p id=a style='display:block'>a<div>d</div>", "d"),
        (".x{visibility:hidden}", "<div class=x>a<p style='visibility:visible'>b</p></div>", "b"),
        ("body .menu > li.off, .\\31 0{display:none}", "<ul class=menu><li class=off>a<li>b</ul><b class=10>c</b>", "- b"),
        ("body > .x{display:none}", "<div class=x>a</div><div><i class=x>b</i></div>", "b"),
        (",".join(f".c{i}" for i in range(900)) + "{color:red;" + "margin:0;" * 900 + "display:none}", "<p class=c7>a<p>b", "b"),
        ("@import 'x'; @font-face{font-family:x} p::before{content:'}{'} .x{content:';';display:none", "<p class=x>a<p>b", "b"),
        ("[hidden]{display:block}", "<p hidden>a", "a"),
    ],
)
def test_style_sheets(css, body, text):
    assert h.render(f"<style>{css}</style>{body}") == text


def test_drawings_formulas_and_sheets_for_paper():
    assert h.render("<p>a <svg><defs><text>n</text></defs><path d='M0'/><title/><text>One</text><text x=1>Two <tspan>x</tspan></text></svg> b") == "a One Two x b"
    assert h.render("<p>e <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>n</annotation></math> f<svg><defs><p>out") == "e x=2 f\n\nout"
    assert h.render("<style media=print>p{display:none}</style><p>a") == "a"
    deep = "<style>.a div > .b{display:none}</style>" + "<div>" * 30_000 + "x<i class=b>y</i>"
    assert h.render(deep) == "xy"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p title='" + "a>" * 20_000 + "'>x", "x"),
        ('<p title = "a > b">x', "x"),
        ("<ol start=1234567><li>a<li>b</ol>", "1234567. a\n1234568. b"),
        ("<ol start=0><li>a<li>b</ol><ol start=-5><li>c<li value=-9>d<li>e</ol>", "0. a\n1. b\n\n-5. c\n-9. d\n-8. e"),
        ("<ol reversed><li>a<li>b<ul><li>x</ul><li>c</ol>", "3. a\n2. b\n   - x\n1. c"),
        ("<ol type=a start=26><li>a<li>b</ol><ol type=I><li>c<li type=i value=49>d<li>e</ol>", "z. a\naa. b\n\nI. c\nxlix. d\nL. e"),
        ("<style>@media print{.h{display:none}}</style><p class=h>x", "x"),
        ("<style>.a,.b{" + "x:y;" * 900 + "display:none}</style><p class=b>x<p>y", "y"),
        ("<ol start=99999999999><li value=x>a</ol>", "1. a"),
    ],
)
def test_numbers_and_long_values(page, text):
    assert h.render(page) == text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text("ab ü中", max_size=9), min_size=1, max_size=5), min_size=1, max_size=6))
def test_tables_by_brute_force(rows):
    """A column begins two places after the longest cell of the one before it, in every row."""
    rows = [[" ".join(c.split()) for c in row] for row in rows]
    wide = max(map(len, rows))
    width = [max([h.shown(r[c]) for r in rows if c < len(r)], default=0) for c in range(wide)]
    want = []
    for row in rows:
        line = ""
        for c, cell in enumerate(row):
            line += " " * (sum(width[:c]) + 2 * c - h.shown(line)) + cell if cell else ""
        want.append(line)
    page = "<table>" + "".join("<tr>" + "".join(f"<td>{c}" for c in row) for row in rows) + "</table>"
    assert [x for x in h.render(page).split("\n") if x] == [x for x in want if x]


@pytest.mark.parametrize(
    "page, text",
    [
        ("<span style='display:block'>a</span><span style='display:block'>b</span>", "a\nb"), ("<style>.b{display:block}</style><span class=b>a</span><span class=b>b</span>c", "a\nb\nc"),
        ("<style>.b{display:block} .b{display:inline}</style><span class=b>a</span><span class=b>b</span>", "ab"), ("<a>link</a><button>Go</button>now", "link Go now"),
        ("<div style='display:inline'>a</div><div style='display:inline'>b</div>", "ab"), ("<p style='white-space:pre'>a  b\n  c</p>", "a  b\n  c"), ("<pre style='white-space:normal'>a  b\n  c</pre>", "a b c"),
        ("<style>code{white-space:pre-wrap}</style><code>a  b<b>\n c</b></code> d  e", "a  b\n c d e"), ("<div style='white-space:pre-line'>a  b\n  c<b> d\n</b>e</div>", "a b\nc d\ne"), ("<pre>a <i style='white-space:nowrap'>b   c</i></pre>", "a b c"),
        ("<ul><li style='display:inline'>a</li> <li style='display:inline'>b</li></ul>", "a b"), ("<ol><li style='display:block'>x<li>y</ol>", "x\n2. y"), ("<i style='display:table-cell'>a</i><i style='display:table-cell'>b</i>", "a b"),
        ("c<textarea>x\n y</textarea>d<select><option>o1<option>o2</select>z", "cx\n y d\no1\no2\nz"), ("<blockquote style='display:contents'>q</blockquote>r", "qr"), ("<table><tr><td style='display:block'>a<td>b</table>", "a  b"),
    ],
)
def test_boxes_by_display(page, text):
    assert h.render(page) == text


def test_blocks_and_lists_by_brute_force():
    """Trees of boxes against lines that are put together from leaf to leaf."""
    draw = random.Random(5)

    def tree(depth):
        kind = draw.choice(("div", "span", "div inline", "span block", "ul", "ol")) if depth else "word"
        if kind == "word":
            return ("word", f"w{draw.randrange(100)}", [])
        if kind in ("ul", "ol"):
            return (kind, draw.randrange(1, 5), [("li", None, [tree(depth - 1) for _ in range(draw.randrange(1, 3))]) for _ in range(draw.randrange(1, 4))])
        return (kind, None, [tree(depth - 1) for _ in range(draw.randrange(1, 4))])

    def page(node):
        kind, value, below = node
        if kind == "word":
            return value
        inner = "".join(map(page, below))
        tag, _, display = kind.partition(" ")
        return f"<{tag}{f' style=display:{display}' if display else ''}{f' start={value}' if tag == 'ol' else ''}>{inner}</{tag}>"

    def lines(node, around):
        """Runs of (path of open items, block number) and text; a new line begins where the block number changes."""
        kind, value, below = node
        if kind == "word":
            around["out"].append((around["block"], tuple(around["marks"]), value))
            return
        block = kind in ("div", "span block", "ul", "ol", "li")
        around["block"] += block
        for i, b in enumerate(below):
            if kind in ("ul", "ol"):
                around["marks"].append([f"{value + i}. " if kind == "ol" else "- ", False])
            lines(b, around)
            if kind in ("ul", "ol"):
                around["marks"].pop()
        around["block"] += block

    for _ in range(150):
        made = ("div", None, [tree(3)])
        around = {"out": [], "block": 0, "marks": []}
        lines(made, around)
        want = []
        for _, run in itertools.groupby(around["out"], lambda x: x[0]):
            run = list(run)
            prefix = ""
            for n, mark in enumerate(run[0][1]):
                last = n == len(run[0][1]) - 1
                prefix += mark[0] if last and not mark[1] else " " * len(mark[0])
                mark[1] = mark[1] or last
            want.append(prefix + "".join(x[2] for x in run))
        got = [line for line in h.render(page(made)).split("\n") if line]
        if all(len(x[1]) < 2 for x in around["out"]):  # of lists in lists only the words
            assert got == want, page(made)
        assert [re.sub(r"^(?: |- |\d+\. )*", "", line) for line in got] == [re.sub(r"^(?: |- |\d+\. )*", "", line) for line in want], page(made)
