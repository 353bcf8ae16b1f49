"""The scanner against the standard library's parser on crooked pages."""

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from pricewright.functions.markup import page_tokens, scanned_text, scanned_title


class Lines(HTMLParser):
    """Text between tags; every other token ends a stretch."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden = [""], None

    def _cut(self, *_):
        self.parts.append("")

    def handle_starttag(self, tag, attrs):
        self.hidden = tag if tag in ("script", "style") else None
        self._cut()

    def handle_startendtag(self, tag, attrs):
        self._cut()

    def handle_endtag(self, tag):
        self.hidden = None
        self._cut()

    handle_comment = handle_decl = unknown_decl = handle_pi = _cut

    def handle_data(self, data):
        if not self.hidden:
            self.parts[-1] += data


def parsed(body):
    parser = Lines()
    parser.feed(body)
    parser.close()
    return "\n".join(part.strip() for part in parser.parts if part.strip())


CROOKED = [
    '<a title="x > y">hi</a> a < b <b>t', "<p>x<!-- c > <b>q</b> --> y", '<script>var a="<p>no</p>";if(a<b){}</script>z',
    "<style>p{}</style", "<p unclosed", "a <3 b", "<a href=x>1<br/>2", "<!doctype html><p>q", "<?php x ?>z", "</ p>x",
    "<p a='\">'>k", "<script>abc", "<!-- open", '<a b="c\nd">z', "<p/ >a", "x<", '<a"b>c', '<a b=c"d>e">f', "</>x", "<!>y",
    "<!-->z", '<a b="u>v', "<p don't>x <i>isn't</i>", "<!-- <script> -->seen<script><!-- </script>too",
    '<div data-x="<!--">one</div><div data-y="-->">two</div>', "<SCRIPT type='a>b'>x</ScRiPt >y", "<a b = 'p>q' c=\">\">r",
    "", "&lt;b&gt; &amp; &#65;", "<p><p><p>", "a<b", "<<b>c", "<scripted>shown</scripted>", "<a b=''>e", "<a b=>f>g"]


def scanned(spark, bodies):
    rows = spark.createDataFrame([(i, f"<html><body class='m'>{b}") for i, b in enumerate(bodies)], "i int, html string")
    rows = rows.withColumn("t", page_tokens(F.col("html")))
    got = rows.select("i", scanned_text(F.col("t")).alias("text"), (F.array_join("t", "") == F.col("html")).alias("whole"))
    rows = sorted(got.collect())
    assert all(row.whole for row in rows)
    return [row.text for row in rows]


def test_crooked_pages_equal_the_parser(spark):
    assert scanned(spark, CROOKED) == [parsed(body) for body in CROOKED]


def test_shuffled_fragments_equal_the_parser(spark):
    random.seed(4)
    pieces = ["text ", "<p>", "</p>", "<a href='x>y'>", '<b c="<i>">', "<!-- <p> -->", "<script>a<b</script>", " < ", "<br/>",
              "<style>q</style>", "it's ", "<i d=e>", '"', "\n", "<hr a b=c>", "<!DOCTYPE x>"]
    bodies = ["".join(random.choices(pieces, k=random.randint(1, 14))) for _ in range(800)]
    for body, got in zip(bodies, scanned(spark, bodies), strict=True):
        assert got == parsed(body), body


def test_titles_bodies_and_missing_pages(spark):
    pages = ["<title a='>'>A &amp; <b>B</b></title><body>x", "<!-- <title>no</title> --><body x='</body>'>y</body> tail",
             "no body", None, "<body>" + "<a b='" + "z>" * 50_000 + "'>" + "w " * 100_000]
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, html string").withColumn("t", page_tokens(F.col("html")))
    got = {r.i: (r.title, r.text) for r in rows.select(
        "i", scanned_title(F.col("t")).alias("title"), scanned_text(F.col("t")).alias("text")).collect()}
    assert got[0] == ("A & B", "x")
    assert got[1] == ("No title found", "y")
    assert got[2] == ("No title found", "")
    assert got[4][1] == ("w " * 100_000).strip()
