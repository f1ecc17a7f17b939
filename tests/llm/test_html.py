import re

import pytest
from loadkit.llm import html_text, queries


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("a  b\n c", "a b c"),
        ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
        ("<b>bo</b>ld <i>x</i>", "bold x"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n    - c\n- d\n\ne"),
        ("<ol start=3><li>a<li value=7>b<li>c</ol>", "3. a\n7. b\n8. c"),
        ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"),
        ("<table><caption>T</caption><tr><th>x<th>y<tr><td rowspan=2>1<td>2<tr><td>3</table>z", "T\nx  y\n1  2\n   3\n\nz"),
        ("<table><tr><td colspan=2>wide<td>e<tr><td>a<td>b<td>c</table>", "wide     e\na     b  c"),
        ("<td>no table</td>", "no table"),
        ("<head><title>t</title><style>p{}</style></head><body>x<script>y</script><!-- z --><noscript>n</noscript>", "x"),
        ("<title>t</title><p>x", "x"),
        ("<div hidden>a</div><span style='display: none'>b</span><p style='visibility:hidden'>c</p>d", "d"),
        ("<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>", "s\nt\nyes"),
        ("<pre>a  b\n  c</pre>d", "a  b\n  c\n\nd"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("&lt;x&gt; &amp; &eacute;&#8364;", "<x> & é€"),
        ("<p>a</b></i></p></div>b</span>", "a\n\nb"),
        ("<blockquote>q</blockquote><dl><dt>t<dd>d<dt>u</dl>", "  q\n\nt\n  d\nu"),
        ("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>", "in  ner  out"),
        ("<h1>h</h1><hr><p>p</p>", "h\n\np"),
        ("a < b <unknown>c</unknown> <", "a < b c <"),
    ],
)
def test_layout(html, text):
    assert html_text.to_text(html) == text


def test_pages_keep_their_words(spark, sf):
    """Against tags taken out by patterns: the same words in the same order."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.op2(spark, sf).collect()
    assert len(got) == len(pages)
    inline = re.compile(r"</?(?:a|b|i|em|span)\b[^>]*>")
    for r in got:
        page = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<(script|style)\b.*?</\1>", " ", pages[r.page_id])
        import html

        plain = html.unescape(re.sub(r"<[^>]+>", " ", inline.sub("", page)))
        assert re.sub(r"(?m)^\s*- ", "", r.text).split() == plain.split(), r.page_id


def test_odd_rows(spark):
    """Nulls, empty and long pages, deep nesting, repeated rows, clashing columns, an empty table."""
    deep = "<div>" * 30_000 + "x" + "<table><tr><td>" * 2000 + "y"
    rows = [(1, None), (2, ""), (3, deep), (4, "<p>word " * 50_000), (5, "<" * 20_000), (None, "<p>a"), (None, "<p>a"), (6, "<table><tr><td rowspan=65534 colspan=1000>a" * 50)]
    df = spark.createDataFrame([(i, h, "t") for i, h in rows], "page_id long, html string, text string")
    got = html_text.extract(df, ["page_id"]).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[1] == by_id[2] == "" and by_id[None] == "a" and by_id[3].split() == ["x", "y"] and by_id[4].count("word") == 50_000
    assert html_text.extract(df.limit(0), ["page_id"]).collect() == []
