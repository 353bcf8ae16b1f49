import html as html_module
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from pricewright.functions.deals import split_features
from pricewright.functions.pages import page_links, page_text, snippet_text, unescape
from pricewright.functions.prices import (
    cut_at_price,
    freight_reply_price,
    lookup_text,
    plain_number,
    priced_prompt,
    reply_price,
    signed_number,
)
from pricewright.functions.products import (
    description_of,
    pounds,
    scrub,
    simplify,
    without_code_tokens,
    without_codes_in_line,
)
from pricewright.functions.replies import (
    criteria_list,
    issue_error,
    json_lines,
    json_part,
    leaves_root,
    message_text,
    question_error,
    render,
    without_control,
    without_fences,
)
from pricewright.functions.terms import cut_tokens, longest_words, token_count, tokens
from pricewright.operators.documents import apply_patches, joined_in_order, pair_by_position, site_bundles
from pricewright.plans.inputs import table


@pytest.fixture(scope="module")
def value(spark):
    """The value of a column function for each given text."""

    def run(function, *texts):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        done = rows.select("i", function(F.col("t")).alias("v")).orderBy("i")
        return [r.v for r in done.collect()]

    return run


def test_plain_numbers(value):
    texts = ["$1,234.56", "-5", "-5.5", "1234.56", "none", "", "€", "from 3 to 4"]
    assert value(plain_number, *texts) == [1234.56, 5.0, -5.5, 1234.56, 0.0, 0.0, 0.0, 3.0]
    assert value(signed_number, "-5", "- 5") == [-5.0, 5.0]
    assert value(lambda t: plain_number(t, "$,€¥"), "€1,5") == [15.0]


def test_reply_prices(value):
    assert value(reply_price, "1234.56", "$1,234.56", "about 99", "no", "") == [123.0, 1234.56, 99.0, 0.0, 0.0]
    assert value(freight_reply_price, "1234.56 USD", "$1,234.5", "77", "no", "") == ["1234.56", "1234.50", "77.00", "0", "0"]


def test_prompts_round_halves_to_even(spark):
    rows = spark.createDataFrame([(2.5,), (3.5,), (0.5,)], "p double")
    got = [r[0].rsplit("$", 1)[1] for r in rows.select(priced_prompt(F.lit("x"), F.col("p"))).collect()]
    assert got == ["2.00", "4.00", "0.00"]
    cut = rows.select(cut_at_price(priced_prompt(F.lit("x"), F.col("p")))).first()[0]
    assert cut.endswith("x\n\nPrice is $")


def test_lookup_sentences(spark):
    rows = spark.createDataFrame([("Rome", 5.0), ("Rome", 5.25), ("Nowhere", None), (" ", None), (None, None)], "c string, p double")
    got = [r[0] for r in rows.select(lookup_text(F.col("c"), F.col("p"))).collect()]
    assert got == ["The price of a ticket to Rome is $5.", "The price of a ticket to Rome is $5.25.",
                   "No price data available for Nowhere.", *["Please provide a destination city."] * 2]


def test_simplify(value):
    assert value(lambda t: simplify(F.array(t)), " a\nb\r\tc  d   e ") == ["a bc d  e"]
    assert len(value(lambda t: simplify(F.array(t)), "x" * 5000)[0]) == 3000


def test_codes(value):
    texts = ["keep ABCDEFG", "drop AB12345 it", "ABCDEFG then 7", "ABC1234\nnext", "lower abc12345", "SHORT1"]
    assert value(without_codes_in_line, *texts) == [
        "keep ABCDEFG", "drop  it", " then 7", "\nnext", "lower abc12345", "SHORT1"]
    assert value(without_code_tokens, *texts) == [
        "keep ABCDEFG", "drop  it", "ABCDEFG then 7", "ABC1234\nnext", "lower abc12345", "SHORT1"]


def test_scrub_drops_unwanted_details(spark):
    row = spark.createDataFrame(
        [("T", ["d1", "d2"], [], {"Part Number": "1", "Color": 'say "x"'})],
        "t string, d array<string>, f array<string>, m map<string,string>")
    got = row.select(scrub(F.col("t"), F.col("d"), F.col("f"), F.col("m"))).first()[0]
    assert got == 'T\nd1 d2\n{"Color": "say \\"x\\""}'


def test_weights(value):
    texts = ["2 pounds", "8 Ounces", "3 hundredths pounds", "453.592 grams", "1 kilograms", "5 stone", "x pounds", None, "4"]
    got = value(pounds, *texts)
    assert got[:4] == [2.0, 0.5, 0.03, 1.0]
    assert got[4] == pytest.approx(1 / 0.453592)
    assert got[5:] == [0.0] * 4


def test_descriptions(spark):
    rows = spark.createDataFrame(
        [("t", "s", "f", "c"), ("t", "s", "", None), ("t", None, " ", None), (None, None, None, "c"), ("t", None, None, "c")],
        "t string, s string, f string, c string")
    got = [r[0] for r in rows.select(description_of(*[F.col(c) for c in "tsfc"])).collect()]
    assert got == ["t. f Category: c.", "t. s", "t", "Unknown product", "t. t Category: c."]


def test_json_parts(value):
    texts = ['{"a": 1}', 'x {"a": {"b": 1}} y', "list [1, 2] end", "none", ' [1] {"x"']
    assert value(json_part, *texts) == ['{"a": 1}', '{"a": {"b": 1}}', "[1, 2]", None, '[1] {"x"']
    assert value(json_lines, '{"a":1}{"b":2}\n\n {"c":3}') == [['{"a":1}', '{"b":2}', ' {"c":3}']]
    assert value(without_control, "a\x00b\nc\x1fd") == ["abcd"]


def test_row_checks(value, spark):
    rows = ['{"question": 1, "keywords": ["k"], "reference_answer": null}', '{"keywords": []}', "no", "[1]",
            '{"question": 1, "keywords": {}, "reference_answer": 2}']
    assert value(question_error, *rows) == [
        None, "missing question", "not JSON", "missing question", "keywords is not a list"]
    paths = ["a/b.md", "../x", "a/../../x", "a/../b", "/etc", "./a"]
    assert value(leaves_root, *paths) == [False, True, True, False, True, False]
    assert value(lambda t: issue_error(F.lit("major"), t), " ", "ok.md") == ["missing path", None]
    assert value(lambda t: issue_error(t, F.lit("p")), None, "minor") == ["missing severity", "severity is not major"]


def test_criteria(value):
    assert value(criteria_list, "a, b\n\n c \n,", " \n", "") == [
        ["a", "b", "c"], *[["Accuracy", "Completeness", "Clarity"]] * 2]


def test_message_content(value):
    texts = ["plain", '["a", "", "b"]', '[{"text": "a"}, {"content": "b"}, "c"]', "[not json"]
    assert value(message_text, *texts) == ["plain", "a b", "a b c", "[not json"]


def test_templates_fill_in_one_pass(spark):
    text, missing = render("{a}-{b}-{a}", {"a": F.lit("{b}"), "b": F.lit("x")})
    assert spark.range(1).select(text).first()[0] == "{b}-x-{b}"
    text, missing = render("{a} {c}", {"a": F.lit("1")})
    assert list(spark.range(1).select(text, missing).first()) == [None, "c"]


def test_fences(value):
    texts = ["```rust\nfn main() {}\n```", "```\nrust\ncode\n```", "plain", "rusty code"]
    assert value(without_fences, *texts) == ["\nfn main() {}\n", "code", "plain", "rusty code"]


def test_tokens(value):
    assert value(tokens, "Don't pay $1,5 für Öl") == [["Don", "'", "t", "pay", "$", "1", ",", "5", "für", "Öl"]]
    assert value(token_count, "", "a b") == [0, 2]
    assert value(lambda t: cut_tokens(t, 3), "a  b, c d", "a b c ", "a b c") == ["a  b,", "a b c ", "a b c"]
    assert value(lambda t: longest_words(t, 3), "The cat THE horse a zebra") == [["horse", "zebra", "cat"]]


def test_features_split_at_the_first_mark(spark):
    rows = spark.createDataFrame(
        [("t" * 120, "one\nmore Features two Features three", "s"), ("t", "plain\ntext", "s"), ("t", None, "short")],
        "title string, content string, summary string")
    got = [(len(r.title), r.details, r.features) for r in split_features(rows).collect()]
    assert got == [(100, "one ", " two Features three"), (1, "plain text", ""), (1, "short", "")]


class _Visible(HTMLParser):
    """What a tolerant parser sees in the body."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.body, self.hidden, self.pieces = False, 0, []

    def handle_starttag(self, tag, attrs):
        self.body = self.body or tag == "body"
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")
        if tag == "body":
            self.body = False

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_data(self, data):
        if self.body and not self.hidden:
            self.pieces.append(data)

    handle_entityref = lambda self, name: self.handle_data(f"&{name};")
    handle_charref = lambda self, name: self.handle_data(f"&#{name};")


def test_page_text_equals_a_parser_on_all_pages(spark, folder):
    for row in table(spark, folder, "pages").select("html", page_text(F.col("html")).alias("t")).collect():
        parser = _Visible()
        parser.feed(row.html)
        # character references arrive as pieces of their own: put texts without a tag between together
        text = html_module.unescape("".join(parser.pieces))
        seen = "".join(row.t.split("\n\n", 1)[1].split())
        assert "".join(text.split())[: len(seen)] == seen


def test_page_details(value):
    page = "<html><body><p>a &lt;b&gt; &amp;lt;</p><img src='x'><a href='/l'>l</a><a href=''>e</a></body></html>"
    assert value(page_text, page) == ["No title found\n\na <b> &lt;\nl\ne"]
    assert value(page_links, page) == [["/l"]]
    open_ended = "<title>T &amp; U</title><body><p>one<br>two<script>hidden </p>"
    assert value(page_text, open_ended) == ["T & U\n\none\ntwo"]
    assert value(unescape, "&#8364;&#x20AC; &bogus; &amp;copy; &copy;&eacute; a & b", "&", "&#99999999;") == [
        "€€ &bogus; &copy; ©é a & b", "&", "&#99999999;"]
    found = '<div class="snippet summary"> Big <b>deal</b>\n&lt;i&gt;now&lt;/i&gt; </div>'
    assert value(snippet_text, found, "no\ndiv") == ["Bigdealnow", "no div"]


def test_bundles_follow_known_links_and_are_cut(spark):
    body = "<title>{0}</title><body>{1}</body>"
    pages = spark.createDataFrame([
        (1, "http://h/a", body.format("A", '<a href="/b">x</a><a href="/gone">y</a><a href="http://h/c">z</a>')),
        (2, "http://h/b", body.format("B", "bee")), (3, "http://h/c", body.format("C", "see " * 2000))],
        "page_id long, url string, html string")
    got = {r.page_id: r.bundle for r in site_bundles(pages).collect()}
    assert got[1].startswith("## Landing Page:\n\nA\n\nx\ny\nz\n## Relevant Links:\n\n\n### Link: /b\nB\n\nbee\n\n### Link: http://h/c\nC")
    assert got[2] == "## Landing Page:\n\nB\n\nbee\n## Relevant Links:\n"
    assert all(len(b) <= 5000 for b in got.values())


def test_patches_see_earlier_changes(spark):
    documents = spark.createDataFrame([("p", "aa"), ("q", "zz"), ("r", "aa")], "path string, text string")
    updates = spark.createDataFrame(
        [(2, ["p"], "b", "c"), (1, ["p", "q"], "a", "b"), (3, ["q"], "z", "y"), (4, ["gone"], "x", "y")],
        "patch long, paths array<string>, search string, replacement string")
    got = {r.path: (r.text, r.unmatched) for r in apply_patches(documents, updates).collect()}
    assert got == {"p": ("cc", []), "q": ("yy", [1]), "gone": (None, [4])}


def test_pairs_fill_the_shorter_side(spark):
    schema = "k string, at long, text string"
    left = spark.createDataFrame([("x", 5, "l2"), ("x", 1, " l1 "), ("x", 3, " ")], schema)
    right = spark.createDataFrame([("x", 2, "r1"), ("y", 1, "r")], schema)
    got = sorted((r.k, r.place, r.input, r.output) for r in pair_by_position(left, right, "k", "at").collect())
    assert got == [("x", 1, "l1", "r1"), ("x", 2, "l2", ""), ("y", 1, "", "r")]


def test_texts_joined_over_several_stretches(spark):
    rows = spark.range(1000).select(F.lit("k").alias("k"), "id", F.col("id").cast("string").alias("t"))
    got = joined_in_order(rows.repartition(4), "k", "id", F.col("t"), ",", stretch=64).first().joined
    assert got == ",".join(str(i) for i in range(1000))
