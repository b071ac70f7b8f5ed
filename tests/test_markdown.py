"""Pages to markdown, element by element, and pages that hold anything."""

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowloom.functions.markdown import html_to_markdown, to_markdown

CASES = {
    "<p>a</p><p>b <b>c</b> <i class='x'>d</i></p>": "a\n\nb **c** *d*",
    "<h1 id='t'>T</h1>x<h3> U </h3>": "# T\n\nx\n\n### U",
    '<a class="k" href="http://h/x?a=1&amp;b=2" title="t">link <b>me</b></a>': "[link **me**](http://h/x?a=1&b=2)",
    "<a>no address</a> <a href='/y'></a>z": "no address z",
    "<ul><li>a<li>b</ul>after": "* a\n* b\n\nafter",
    "<ol start='3'><li>a</li><li><p>b</p><p>c</p></li></ol>": "3. a\n4. b\n\n   c",
    "<ul><li>a<ol><li>x</li><li>y<ul><li>z</li></ul></li></ol></li><li>b</li></ul>": "* a\n  1. x\n  2. y\n     * z\n* b",
    "<p>c:</p><pre class='py'><code>def f(x):\n    return  x &lt; 1\n\n\n\n# end</code></pre><p>d</p>": "c:\n\n```\ndef f(x):\n    return  x < 1\n\n\n\n# end\n```\n\nd",
    "<ul><li>a<pre>x\n  y</pre></li></ul>": "* a\n\n  ```\n  x\n    y\n  ```",
    "<pre>a ``` b</pre>": "````\na ``` b\n````",
    "use <code>a  b</code>.": "use `a b`.",
    "<table><caption>C</caption><thead><tr><th>A</th><th>B</th></tr></thead><tbody><tr><td>1</td><td>x|y<br>z</td></tr></tbody></table>t": "C\n\n| A | B |\n| --- | --- |\n| 1 | x\\|y z |\n\nt",
    "<table><tr><td>a<table><tr><td>in</td></tr></table></td><td><p>b</p></td></tr></table>": "| a in | b |\n| --- | --- |",
    "<blockquote><p>a</p><p>b</p></blockquote>c": "> a\n>\n> b\n\nc",
    "a<br>b<br/><br>c": "a\nb\n\nc",
    "a<hr>b": "a\n\n---\n\nb",
    "<img alt='A' src='/i.png'><img alt='none'>": "![A](/i.png)",
    "<p><b>never closed<br>x<p>y</b>": "never closed\nx\n\ny",
    "<i><b>crossed</i></b>": "*crossed*",
    "<script>var t='</p>';</script><style>p{}</style><!-- <p>x -->ok": "ok",
    "<script>never closed <p>x": "",
    "a &amp;lt; &nbsp; b &#39;&eacute; &unknown; 1 < 2": "a &lt; b 'é &unknown; 1 < 2",
    "<div>a</div><div>b</div>": "a\n\nb",
    " \n ": "",
    "": "",
}


def test_elements(spark):
    frame = spark.createDataFrame([*CASES, None], "string").toDF("html")
    got = {r["html"]: r["md"] for r in frame.select("html", html_to_markdown(F.col("html")).alias("md")).collect()}
    assert got == {**CASES, None: None}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("<p> </p> <b> </b> <i> </i> <ul> </ul> <ol> </ol> <li> </li> <pre> </pre> <table> </table> <tr> </tr> <td> </td> <blockquote> </blockquote> <h2> </h2> <br> <a href='x'> </a> word \n".split(" ") + [" "]), max_size=40))
def test_any_order_of_tags_keeps_the_words(parts):
    page = "".join(parts)
    assert to_markdown(page).count("word") == page.count("word")


N = 100_000
HOSTILE = ["<b>x" * N, "<b>x</i>" * N, "<i>" + "<b>" * N + "</i>" * N, "<ul><li>x" * N, "<blockquote>x" * N, "<table><tr><td>x" * N, "</p>" * N, "<pre>" * N + "x"]
HOSTILE += ["<a " + "k " * N + ">x", "<a " + "k" * N + ">x", "<a " + "k=" * N + ">x", '<a href="' * N, "<" * N, "&" * N, "&amp" * N, "<!--" * N, "<script>" * N, "</script " * N, "`" * N, " " * N, "<li>x" * N, "<td>x" * N]


@pytest.mark.parametrize("page", HOSTILE, ids=lambda p: p[:12])
def test_time_grows_with_the_page(page):
    start = time.time()
    to_markdown(page)
    assert time.time() - start < 5
