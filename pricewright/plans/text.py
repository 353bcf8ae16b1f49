"""Text jobs: pages, replies, deals' descriptions, templates."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import functions as F

from pricewright.functions.deals import describe_deal, split_features
from pricewright.functions.markup import page_tokens, scanned_page, scanned_title
from pricewright.functions.pages import (
    all_links,
    nonempty,
    page_links,
    page_text,
    page_title,
    snippet_text,
)
from pricewright.functions.prices import freight_reply_price, plain_number, reply_price, signed_number
from pricewright.functions.replies import (
    criteria_list,
    issue_error,
    json_lines,
    json_part,
    message_text,
    question_error,
    render,
    without_control,
    without_fences,
)
from pricewright.functions.terms import term_score
from pricewright.operators.documents import site_bundles
from pricewright.operators.ordering import numbered
from pricewright.plans.inputs import table, with_part
from pricewright.plans.registry import query
from pricewright.session import spread

_UNESCAPE = "{0}"
for _name, _code in sorted(name2codepoint.items(), key=lambda entry: entry[0] == "amp"):
    _UNESCAPE = f"replace({_UNESCAPE}, '&{_name};', chr({_code}))"
_TITLE = ("CASE WHEN regexp_matches(html, '(?i)<title') THEN "
          + _UNESCAPE.format("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
          + " ELSE 'No title found' END")
_BODY = "regexp_extract(html, '(?is)<body[^>]*>(.*</body>|.*)', 1)"
for _unseen in ("(?is)<script.*?(</script>|\\z)", "(?is)<style.*?(</style>|\\z)", "(?s)<!--.*?-->", "(?s)<[^>]*>"):
    _BODY = f"regexp_replace({_BODY}, '{_unseen}', chr(1), 'g')"
_BLANKS = "' ' || chr(10) || chr(13) || chr(9) || chr(160)"
_VISIBLE = (f"array_to_string(list_filter(list_transform(string_split(" + _UNESCAPE.format(_BODY) + ", chr(1)), lambda p: trim(p"
            f", {_BLANKS})), lambda p: p <> ''), chr(10))")
_PAGE = f"({_TITLE} || chr(10) || chr(10) || {_VISIBLE})[1:2000]"
_LINKS = "regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*[\"'']([^\"'']*)[\"'']', 1)"


@query("page_text", f"SELECT page_id, {_TITLE} AS title, {_PAGE} AS page_text FROM pages")
def text_of_pages(spark, folder):
    html = F.col("html")
    return spread(table(spark, folder, "pages").select("page_id", "html")).select(
        "page_id", page_title(html).alias("title"), page_text(html).alias("page_text"))


@query("page_text_scanned", f"SELECT page_id, {_TITLE} AS title, {_PAGE} AS page_text, true AS whole FROM pages")
def scanned_pages(spark, folder):
    # one pass of the scanner per page; its tokens serve all columns
    pages = spread(table(spark, folder, "pages").select("page_id", "html")).withColumn("tokens", page_tokens(F.col("html")))
    tokens = F.col("tokens")
    return pages.select("page_id", scanned_title(tokens).alias("title"), scanned_page(tokens).alias("page_text"),
                        (F.array_join(tokens, "") == F.col("html")).alias("whole"))


@query("scan_pages", f"""
  SELECT page_id, url, {_PAGE} AS page_text, len(list_filter({_LINKS}, lambda l: l <> '')) AS n_links FROM pages""")
def scan_pages(spark, folder):
    html = F.col("html")
    return table(spark, folder, "pages").select(
        "page_id", "url", page_text(html).alias("page_text"),
        F.size(page_links(html)).cast("long").alias("n_links"))


@query("page_links", f"""
  WITH l AS (SELECT page_id, list_filter({_LINKS}, lambda l: l <> '') AS links FROM pages)
  SELECT page_id, unnest(range(len(links))) AS position, unnest(links) AS link FROM l""")
def links_of_pages(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", F.posexplode(page_links(F.col("html"))).alias("position", "link")
    ).withColumn("position", F.col("position").cast("long"))


@query("nonempty_links", f"""
  WITH l AS (SELECT page_id, list_transform({_LINKS}, lambda x: CASE WHEN x = '/the' THEN '' ELSE x END) AS links FROM pages)
  SELECT page_id, len(links) AS n_all, len(list_filter(links, lambda x: x <> '')) AS n_kept FROM l""")
def nonempty_links(spark, folder):
    # one common target is blanked, as the pages here have no empty ones
    links = F.transform(all_links(F.col("html")), lambda x: F.when(x == "/the", "").otherwise(x))
    return table(spark, folder, "pages").select(
        "page_id", F.size(links).cast("long").alias("n_all"),
        F.size(nonempty(links)).cast("long").alias("n_kept"))


@query("snippet_text", f"""
  SELECT page_id, replace({_UNESCAPE.format("trim(regexp_extract(html, '(?is)<div class=\"ad\">(.*?)</div>', 1))")},
     chr(10), ' ') AS advert, replace(html, chr(10), ' ') AS fallback FROM pages""")
def snippets(spark, folder):
    html = F.col("html")
    return table(spark, folder, "pages").select(
        "page_id", snippet_text(html, "ad").alias("advert"), snippet_text(html).alias("fallback"))


@query("site_bundle", f"""
  WITH t AS (SELECT page_id, url, html, {_PAGE} AS page FROM pages),
  l AS (SELECT page_id, url, list_filter({_LINKS}, lambda l: l <> '') AS links FROM pages),
  e AS (SELECT page_id, url, unnest(range(len(links))) AS place, unnest(links) AS link FROM l),
  r AS (SELECT page_id, place, link, CASE WHEN link LIKE 'http%' THEN link
     ELSE regexp_extract(url, '^(https?://[^/]+)', 1) || CASE WHEN link LIKE '/%' THEN '' ELSE '/' END || link END AS target FROM e),
  p AS (SELECT r.page_id, string_agg(chr(10) || chr(10) || '### Link: ' || link || chr(10) || t.page, '' ORDER BY place) AS tail
     FROM r JOIN t ON t.url = r.target GROUP BY 1)
  SELECT t.page_id, t.url, ('## Landing Page:' || chr(10) || chr(10) || t.page || chr(10) || '## Relevant Links:' || chr(10)
     || coalesce(p.tail, ''))[1:5000] AS bundle FROM t LEFT JOIN p ON t.page_id = p.page_id""")
def bundles(spark, folder):
    return site_bundles(spread(table(spark, folder, "pages")))


_OFFER = """content AS (SELECT doc_id, CASE WHEN n_chars % 2 = 0 THEN text || chr(10) || 'more Features ' || lang || chr(10) || 'and Features ' || source
  WHEN n_chars % 3 <> 0 THEN text END AS content, text, source FROM documents),
flat AS (SELECT *, replace(replace(content, chr(10) || 'more', ''), chr(10), ' ') AS line FROM content),
cut AS (SELECT doc_id, text[1:100] AS title, source,
  CASE WHEN content IS NULL THEN 'From ' || source
       WHEN contains(line, 'Features') THEN line[1:strpos(line, 'Features') - 1] ELSE line END[1:500] AS details,
  CASE WHEN contains(line, 'Features') THEN line[strpos(line, 'Features') + 8:] ELSE '' END[1:500] AS features FROM flat)"""


def _offers(spark, folder):
    extra = F.concat(F.lit("\nmore Features "), "lang", F.lit("\nand Features "), "source")
    content = F.when(F.col("n_chars") % 2 == 0, F.concat("text", extra)).when(
        F.col("n_chars") % 3 != 0, F.col("text"))
    documents = table(spark, folder, "documents")
    return split_features(documents.select(
        "doc_id", F.col("text").alias("title"), content.alias("content"),
        F.concat_ws(" ", F.lit("From"), "source").alias("summary"), F.col("source").alias("url")))


@query("split_features", f"WITH {_OFFER} SELECT doc_id, title, details, features FROM cut")
def features_split(spark, folder):
    return _offers(spark, folder).drop("url")


@query("describe_deal", f"""
  WITH {_OFFER} SELECT doc_id, 'Title: ' || title || chr(10) || 'Details: ' || trim(details) || chr(10) ||
   'Features: ' || trim(features) || chr(10) || 'URL: ' || source AS description FROM cut""")
def deal_descriptions(spark, folder):
    return _offers(spark, folder).select("doc_id", describe_deal().alias("description"))


def _price_texts(spark, folder):
    price, k = F.col("value"), F.col("event_id")
    texts = [
        F.concat(F.lit("$"), price.cast("string")),
        F.concat(F.lit("It costs 1,"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(".50 today")),
        F.concat(F.lit("-"), (k % 50).cast("string")),
        F.concat((k % 9000 + 1000).cast("string"), F.lit(".25 USD")),
        F.lit("no price"),
    ]
    return table(spark, folder, "events").select(
        "event_id", F.element_at(F.array(*texts), (k % 5 + 1).cast("int")).alias("reply"))


_PRICE_TEXTS = """replies AS (SELECT event_id, ['$' || CAST(value AS VARCHAR),
  'It costs 1,' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || '.50 today', '-' || event_id % 50,
  (event_id % 9000 + 1000) || '.25 USD', 'no price'][event_id % 5 + 1] AS reply FROM events),
bare AS (SELECT event_id, reply, replace(replace(reply, '$', ''), ',', '') AS b FROM replies)"""


@query("extract_price", f"""
  WITH {_PRICE_TEXTS}
  SELECT event_id, reply, coalesce(try_cast(regexp_extract(b, '[-+]?\\d*\\.\\d+|\\d+') AS DOUBLE), 0) AS price,
   coalesce(try_cast(regexp_extract(b, '[-+]?(?:\\d*\\.\\d+|\\d+)') AS DOUBLE), 0) AS signed_price FROM bare""")
def extract_price(spark, folder):
    reply = F.col("reply")
    return _price_texts(spark, folder).select(
        "event_id", "reply", plain_number(reply).alias("price"), signed_number(reply).alias("signed_price"))


@query("extract_price_patterns", f"""
  WITH {_PRICE_TEXTS},
  p AS (SELECT event_id, reply, coalesce(nullif(regexp_extract(reply, '\\$?\\s*(\\d{{1,3}}(?:,\\d{{3}})*(?:\\.\\d{{2}})?)', 1), ''), '0') AS a,
    coalesce(nullif(regexp_extract(reply, '\\$?\\s*(\\d{{1,3}}(?:,\\d{{3}})+(?:\\.\\d{{1,2}})?)', 1), ''),
             nullif(regexp_extract(reply, '\\$?\\s*(\\d+\\.\\d{{1,2}})', 1), ''), nullif(regexp_extract(reply, '\\$?\\s*(\\d+)', 1), '')) AS f FROM replies)
  SELECT event_id, CAST(replace(a, ',', '') AS DOUBLE) AS price,
    coalesce(printf('%.2f', CAST(replace(f, ',', '') AS DOUBLE)), '0') AS freight_price FROM p""")
def extract_price_patterns(spark, folder):
    return _price_texts(spark, folder).select(
        "event_id", reply_price(F.col("reply")).alias("price"),
        freight_reply_price(F.col("reply")).alias("freight_price"))


_WRAPPED = """wrapped AS (SELECT event_id, [props, 'Sure! ' || props || ' Hope it helps.', '  ' || props || chr(10),
  'Scores: [' || user_id || ', 2] done', 'nothing here'][event_id % 5 + 1] AS reply FROM events)"""


@query("extract_json_text", f"""
  WITH {_WRAPPED}, t AS (SELECT event_id, CASE event_id % 5 WHEN 3 THEN regexp_extract(reply, '\\[.*\\]')
    WHEN 4 THEN NULL ELSE regexp_extract(reply, '\\{{.*\\}}') END AS json_text FROM wrapped)
  SELECT event_id, json_text, CASE WHEN event_id % 5 < 3 THEN CAST(json_extract_string(json_text, '$.k') AS BIGINT) END AS k FROM t""")
def extract_json_text(spark, folder):
    props, k = F.col("props"), F.col("event_id")
    replies = [
        props, F.concat(F.lit("Sure! "), props, F.lit(" Hope it helps.")),
        F.concat(F.lit("  "), props, F.lit("\n")),
        F.concat(F.lit("Scores: ["), F.col("user_id").cast("string"), F.lit(", 2] done")),
        F.lit("nothing here"),
    ]
    reply = F.element_at(F.array(*replies), (k % 5 + 1).cast("int"))
    return table(spark, folder, "events").select("event_id", json_part(reply).alias("json_text")).withColumn(
        "k", F.get_json_object("json_text", "$.k").cast("long"))


@query("strip_control", "SELECT doc_id, regexp_replace(text, '[\\x00-\\x1f]', '', 'g') AS cleaned FROM documents")
def strip_control(spark, folder):
    return table(spark, folder, "documents").select("doc_id", without_control(F.col("text")).alias("cleaned"))


@query("validate_rows", """
  SELECT event_id, ['ok', 'missing keywords', 'keywords is not a list', 'missing reference_answer', 'not JSON'][event_id % 5 + 1] AS question_status,
    CASE WHEN event_type = 'view' THEN 'missing severity' WHEN event_type <> 'click' THEN 'severity is not major'
         WHEN user_id % 4 = 0 THEN 'missing path'
         WHEN user_id % 4 IN (1, 2) AND user_id % 3 <> 0 THEN 'path leaves the root' ELSE 'ok' END AS issue_status
  FROM events""")
def validate_rows(spark, folder):
    k, user = F.col("event_id"), F.col("user_id")
    rows = [
        '{"question": "q", "keywords": ["a"], "reference_answer": "r"}', '{"question": "q", "reference_answer": "r"}',
        '{"question": "q", "keywords": "a", "reference_answer": "r"}', '{"question": "q", "keywords": []}',
        '{"question": ',
    ]
    row = F.element_at(F.array(*[F.lit(r) for r in rows]), (k % 5 + 1).cast("int"))
    severity = F.when(F.col("event_type") == "click", "major").when(F.col("event_type") != "view", "minor")
    climbing = F.when(user % 3 == 0, F.concat(F.lit("a/../"), "event_type")).otherwise(
        F.when(user % 4 == 1, F.concat(F.lit("../"), "event_type")).otherwise(
            F.concat(F.lit("a/../../"), "event_type")))
    path = F.when(user % 4 == 0, "  ").when(user % 4 == 3, "docs/x.md").otherwise(climbing)
    return table(spark, folder, "events").select(
        "event_id", F.coalesce(question_error(row), F.lit("ok")).alias("question_status"),
        F.coalesce(issue_error(severity, path), F.lit("ok")).alias("issue_status"))


@query("split_glued_json", """
  SELECT event_id, 0 AS position, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
  UNION ALL SELECT event_id, 1, user_id FROM events
  UNION ALL SELECT event_id, 2, NULL FROM events WHERE event_id % 2 = 0""")
def split_glued_json(spark, folder):
    glued = F.concat(
        "props", F.lit('{"k": '), F.col("user_id").cast("string"), F.lit("}\n\n"),
        F.when(F.col("event_id") % 2 == 0, "broken").otherwise(""))
    lines = table(spark, folder, "events").select(
        "event_id", F.posexplode(json_lines(glued)).alias("position", "line"))
    return lines.select("event_id", "position", F.get_json_object("line", "$.k").cast("long").alias("k"))


@query("criteria_list", """
  SELECT p_partkey, CASE WHEN p_size = 7 THEN 'Accuracy|Completeness|Clarity'
    ELSE 'Speed|' || p_name || '|' || p_brand END AS criteria FROM part""")
def criteria_lists(spark, folder):
    text = F.when(F.col("p_size") == 7, " \n , ").otherwise(
        F.concat(F.lit(" Speed, "), "p_name", F.lit(",\n\n"), "p_brand", F.lit(" \n")))
    return table(spark, folder, "part").select(
        "p_partkey", F.array_join(criteria_list(text), "|").alias("criteria"))


@query("term_score", """
  WITH t AS (SELECT doc_id, text, p_type, p_name FROM documents JOIN part ON doc_id % (SELECT count(*) FROM part) = p_partkey)
  SELECT doc_id, CAST(contains(lower(text), 'the') AS BIGINT) + CAST(contains(lower(text), 'que') AS BIGINT)
   + CAST(contains(lower(text), 'der') AS BIGINT) + CAST(contains(lower(text), lower(split_part(p_name, ' ', 1))) AS BIGINT) AS score FROM t""")
def term_scores(spark, folder):
    rows = with_part(spark, folder, table(spark, folder, "documents"))
    terms = F.array(F.lit("The"), F.lit("que"), F.lit("DER"), F.split("p_name", " ")[0])
    return rows.select("doc_id", term_score(F.col("text"), terms, 8).alias("score"))


@query("normalise_content", """
  SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN 'user' ELSE role END AS role,
   CASE turn % 3 WHEN 0 THEN text WHEN 1 THEN 'first ' || role ELSE 'one two ' || role END AS content FROM conversations""")
def normalise_content(spark, folder):
    turn, role = F.col("turn"), F.col("role")
    listed = F.to_json(F.array(F.lit("first"), F.lit(""), role))
    parts = F.concat(
        F.lit('[{"text": "one"}, {"content": "two"}, "'), role, F.lit('"]'))
    content = F.when(turn % 3 == 0, F.col("text")).when(turn % 3 == 1, listed).otherwise(parts)
    given = F.when(turn % 5 != 4, role)
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", F.coalesce(given, F.lit("user")).alias("role"),
        message_text(content).alias("content"))


@query("render_template", """
  SELECT p_partkey, CASE WHEN p_size % 6 <> 0 THEN 'Sell ' || p_name || ' by ' || p_brand || ' as {' || p_name || '} of ' || p_size END AS text,
   CASE WHEN p_size % 6 = 0 THEN 'brand' ELSE '' END AS missing FROM part""")
def render_template(spark, folder):
    text, missing = render("Sell {name} by {brand} as {label} of {size}", {
        "name": F.col("p_name"), "brand": F.when(F.col("p_size") % 6 != 0, F.col("p_brand")),
        "label": F.concat(F.lit("{"), "p_name", F.lit("}")), "size": F.col("p_size")})
    return table(spark, folder, "part").select("p_partkey", text.alias("text"), missing.alias("missing"))


@query("strip_fences", """
  SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN text ELSE text || chr(10) END AS code FROM conversations""")
def strip_fences(spark, folder):
    turn = F.col("turn")
    reply = (
        F.when(turn % 3 == 0, F.concat(F.lit("```rust"), "text", F.lit("\n```")))
        .when(turn % 3 == 1, F.concat(F.lit("```"), "text", F.lit("\n")))
        .otherwise(F.concat(F.lit("\n Rust \n"), "text", F.lit("\n```"))))
    return table(spark, folder, "conversations").select("conv_id", "turn", without_fences(reply).alias("code"))


@query("sorted_distinct", """
  SELECT source, row_number() OVER (ORDER BY source) - 1 AS index FROM (SELECT DISTINCT source FROM documents)""")
def sorted_distinct(spark, folder):
    labels = table(spark, folder, "documents").select("source").distinct()
    return numbered(labels, ["source"], "index").withColumn("index", F.col("index") - 1)


@query("meta_label", """
  SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source WHEN doc_id % 3 = 1 THEN lang ELSE 'unknown' END AS label FROM documents""")
def meta_label(spark, folder):
    k = F.col("doc_id")
    metadata = (
        F.when(k % 3 == 0, F.create_map(F.lit("type"), F.col("source"), F.lit("doc_type"), F.col("lang")))
        .when(k % 3 == 1, F.create_map(F.lit("doc_type"), F.col("lang")))
        .when(k % 6 == 2, F.create_map(F.lit("other"), F.col("lang"))))
    return table(spark, folder, "documents").select(
        "doc_id", F.coalesce(metadata["type"], metadata["doc_type"], F.lit("unknown")).alias("label"))
