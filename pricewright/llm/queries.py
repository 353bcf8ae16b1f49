"""The registered queries of this subpackage, with their SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm import (
    content_sort,
    language,
    merkle,
    mixing,
    multiset_hash,
    near_dup,
    packing,
    periodic_runs,
    site_lines,
    substrings,
    token_files,
    vp_trees,
    warc,
)
from pricewright.plans.inputs import table
from pricewright.plans.registry import query
from pricewright.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

_SCHEME = warc.SCHEME
_HOST = (f"regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(u, '{_SCHEME}([^/?#]*)', 1)), '^.*@', ''), "
         r"':[0-9]*$', ''), '^www[0-9]*\.', '')")
_REST = f"regexp_extract(u, '{_SCHEME}[^/?#]*([^#]*)', 1)"
_URL_KEY = (f"CASE WHEN regexp_matches(u, '{_SCHEME}') THEN array_to_string(list_reverse(string_split({_HOST}, '.')), ',') "
            f"|| ')' || CASE WHEN {_REST} = '' THEN '/' ELSE {_REST} END ELSE u END")


@query("op1_warc_index_merge", f"""
    WITH p AS (SELECT page_id, coalesce(url, '') AS u, coalesce(html, '') AS h FROM pages),
    s AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
                 {_URL_KEY} AS urlkey FROM p),
    r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS stays FROM s)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND stays <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND stays <> page_id THEN stays END AS refers_to,
           urlkey,
           row_number() OVER (ORDER BY urlkey, page_id) - 1 AS index_place,
           row_number() OVER (PARTITION BY urlkey ORDER BY page_id) - 1 AS capture_no
    FROM r""")
def warc_round_trip(spark, folder):
    archives = scratch_path(spark, "warc")
    index = warc.merged_index(warc.write_archives(table(spark, folder, "pages"), archives))
    records = warc.read_archives(index, archives).drop("payload")
    places = index.select("file", "offset", "urlkey", "index_place", "capture_no")
    return records.join(places, ["file", "offset"]).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "index_place", "capture_no")


@query("op2_best_fit_packing")
def best_fit_packing(spark, folder):
    return packing.packed_documents(table(spark, folder, "documents"), BYTE_BPE, end_id=2, added=True)


_BLOCK = site_lines.BLOCKS.replace("'", "''")
_LINES = (f"list_filter(list_transform(string_split(regexp_replace(regexp_replace(coalesce(html, ''), '{_BLOCK}', "
          f"chr(10), 'g'), '{site_lines.TAGS}', '', 'g'), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || "
          "chr(10))), lambda x: x <> '')")


@query("op3_site_line_frequency", f"""
    WITH p AS (SELECT page_id, lower(regexp_extract(coalesce(url, ''), '{site_lines.HOST}', 1)) AS host,
                      {_LINES} AS lines FROM pages),
    e AS (SELECT host, unnest(list_distinct(lines)) AS line FROM p),
    t AS (SELECT host, count(*) AS all_pages FROM p GROUP BY host),
    b AS (SELECT host, list(line) AS often FROM (
            SELECT host, line, count(*) AS n FROM e GROUP BY ALL) JOIN t USING (host)
          WHERE n >= {site_lines.LEAST_PAGES} AND n > all_pages * {site_lines.RATIO} GROUP BY host),
    k AS (SELECT page_id, p.host, lines,
                 list_filter(lines, lambda x: NOT list_contains(coalesce(often, []), x)) AS stay
          FROM p LEFT JOIN b ON p.host = b.host)
    SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(stay))::BIGINT AS n_dropped,
           array_to_string(stay, chr(10)) AS kept FROM k""")
def site_line_frequency(spark, folder):
    return site_lines.without_boilerplate(table(spark, folder, "pages"))


_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op4_content_sort", f"""
    WITH n AS (SELECT doc_id, sha256({_NORM}) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM n WINDOW g AS (PARTITION BY text_sha256)""")
def content_sorted(spark, folder):
    return content_sort.equal_texts(table(spark, folder, "documents"))


@query("op5_token_list_files")
def token_list_files(spark, folder):
    files = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, folder, "documents"), files, WORD_BPE, end_id=1, added=True)
    return token_files.token_spans(token_files.read_token_files(spark, files))


@query("op6_multiset_hash")
def multiset_hashes(spark, folder):
    return multiset_hash.edited_likeness(table(spark, folder, "documents"))


@query("op7_language_id")
def language_id(spark, folder):
    return language.identified(table(spark, folder, "documents"))


@query("op8_bayes_near_dup")
def bayes_near_dup(spark, folder):
    return near_dup.linked(table(spark, folder, "documents"))


_UNITS = f"""
    WITH RECURSIVE d AS (SELECT doc_id, source, coalesce('=' || source, '') AS label FROM documents),
    sizes AS (SELECT label, any_value(source) AS source, count(*) AS n,
                     floor(sqrt(count(*)::DOUBLE) * 1000)::BIGINT AS w FROM d GROUP BY label),
    m AS (SELECT greatest({mixing.PERIOD}, 10 * count(*)) AS m, count(*) AS k, greatest(sum(w), 1)::BIGINT AS total
          FROM sizes),
    shared AS (SELECT *, 1 + (w * (m - k)) // total AS base, (w * (m - k)) % total AS rest FROM sizes, m),
    ranked AS (SELECT *, row_number() OVER (ORDER BY rest DESC, label) AS place, sum(base) OVER () AS used FROM shared),
    units AS (SELECT label, source, m::BIGINT AS m, row_number() OVER (ORDER BY label) AS ix,
                     (base + (place <= m - used)::INT)::BIGINT AS units FROM ranked),
    lists AS (SELECT list(units ORDER BY ix) AS u, any_value(m) AS m FROM units),
    edf AS (
        SELECT -1::BIGINT AS t, list_transform(u, lambda x: 0::BIGINT) AS done, 0::BIGINT AS pick FROM lists
        UNION ALL
        SELECT t + 1, list_transform(done, lambda x, i: x + (i = p)::BIGINT), p FROM (
            SELECT t, done, list_min(list_transform(u, lambda x, i: CASE
                WHEN done[i] < x AND (done[i] * m) // x <= t + 1
                THEN (((done[i] + 1) * m + x - 1) // x) * 1000000 + i END)) % 1000000 AS p, m
            FROM edf, lists) WHERE t + 1 < m),
    jobs AS (SELECT pick AS ix, t AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS job FROM edf
             WHERE t >= 0),
    b AS (SELECT doc_id, d.source, label, units, m, ix,
                 (row_number() OVER (PARTITION BY label ORDER BY doc_id) - 1) AS r FROM d JOIN units USING (label)),
    c AS (SELECT *, r // {mixing.BLOCK_ROWS} AS block FROM b)"""


@query("op9_pfair_mixing", f"""{_UNITS}
    SELECT doc_id, source, block, (block // units) * m + ((block % units) * m) // units AS release,
           (block // units) * m + ((block % units + 1) * m + units - 1) // units AS deadline,
           (block // units) * m + slot AS slot,
           row_number() OVER (ORDER BY (block // units) * m + slot, r) - 1 AS place
    FROM c JOIN jobs ON jobs.ix = c.ix AND jobs.job = c.block % units""")
def pfair_mixing(spark, folder):
    return mixing.mixed(table(spark, folder, "documents"))


@query("op10_count_min_substrings")
def count_min_substrings(spark, folder):
    return substrings.without_repeats(table(spark, folder, "documents"), digests=True).withColumnRenamed(
        "kept", "kept_sha256")


# the checksum of a decimal identifier, bit by bit
_CRC32 = ("xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
          "lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) "
          "WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END), 4294967295)")
_FRAMED = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_FRAMED.format(of) for of in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_DEPTH = "CASE WHEN {0} > 1 THEN ceil(log2({0}))::INT ELSE 0 END"


@query("op11_bitmap_manifest", f"""
    WITH RECURSIVE d AS (SELECT *, {_CRC32} AS h FROM documents),
    l AS (SELECT doc_id, coalesce('=' || lang, '') AS label, {_leaf_sql('n_chars')} AS leaf,
                 CASE WHEN h % 7 = 0 THEN {_leaf_sql('(n_chars + 1)')} ELSE {_leaf_sql('n_chars')} END AS claim FROM d),
    k AS (SELECT *, dense_rank() OVER (ORDER BY label) - 1 AS tree, count(*) OVER (PARTITION BY label) AS n,
                 row_number() OVER (PARTITION BY label ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM l),
    t AS (SELECT tree, n, 0 AS level, place AS ix, leaf AS node FROM k
          UNION ALL
          SELECT tree, any_value(n), level + 1, ix // 2, sha256(string_agg(node, '' ORDER BY ix)) FROM t
          WHERE level < {_DEPTH.format('n')} GROUP BY tree, level, ix // 2),
    s AS (SELECT tree, node AS subroot, count(*) OVER () AS n FROM t WHERE level = {_DEPTH.format('n')}),
    u AS (SELECT n, 0 AS level, tree AS ix, subroot AS node FROM s
          UNION ALL
          SELECT any_value(n), level + 1, ix // 2, sha256(string_agg(node, '' ORDER BY ix)) FROM u
          WHERE level < {_DEPTH.format('n')} GROUP BY level, ix // 2),
    r AS (SELECT node AS root FROM u WHERE level = {_DEPTH.format('n')}),
    p AS (SELECT k.tree, k.place, k.doc_id, k.leaf, k.claim, s.subroot, {_DEPTH.format('k.n')} AS depth, s.n AS trees
          FROM k JOIN s ON k.tree = s.tree),
    w AS (SELECT tree, place, unnest(range(0, depth)) AS level, NULL::BIGINT AS of_tree, depth FROM p
          UNION ALL
          SELECT tree, place, depth + unnest(range(0, {_DEPTH.format('trees')})), tree, depth FROM p),
    o AS (SELECT w.tree, w.place, w.level,
                 coalesce(t.node, u.node, '') AS sibling,
                 CASE WHEN of_tree IS NULL THEN (w.place >> w.level) % 2 ELSE (of_tree >> (w.level - w.depth)) % 2 END AS odd
          FROM w LEFT JOIN t ON of_tree IS NULL AND t.tree = w.tree AND t.level = w.level
                            AND t.ix = xor((w.place >> w.level)::BIGINT, 1::BIGINT)
                 LEFT JOIN u ON u.level = w.level - w.depth AND u.ix = xor((of_tree >> (w.level - w.depth))::BIGINT, 1::BIGINT)),
    f AS (SELECT tree, place, string_agg(sibling, '' ORDER BY level) AS siblings,
                 list((CASE WHEN odd = 1 THEN 'L' ELSE 'R' END) || sibling ORDER BY level) AS steps FROM o GROUP BY ALL),
    g AS (SELECT p.*, siblings, list_reduce(list_prepend(claim, coalesce(steps, [])), lambda x, y: sha256(
                 CASE WHEN y[1] = 'L' THEN y[2:] || x ELSE x || y[2:] END)) AS folded_root
          FROM p LEFT JOIN f ON p.tree = f.tree AND p.place = f.place)
    SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root,
           folded_root = root AS verified FROM g, r""")
def bitmap_manifest(spark, folder):
    return verified_manifest(table(spark, folder, "documents"))


def verified_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of documents, each checked against the root after some have been altered."""
    def leaf(n_chars: Column) -> Column:
        return merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    altered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    one_more = F.col("n_chars").cast("decimal(20,0)") + 1
    claim = F.when(altered, leaf(one_more)).otherwise(leaf(F.col("n_chars")))
    return merkle.manifest(docs, leaf(F.col("n_chars")), claim).withColumn(
        "folded_root", merkle.folded(F.col("claim"), F.col("proof"))).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op12_vantage_point_trees")
def vantage_point_trees(spark, folder):
    return vp_trees.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


_LEAST, _TIMES = periodic_runs.LEAST_WORDS, periodic_runs.TIMES
_GRAM = 2 * _LEAST // 3  # every run matches as many words in a row


@query("op13_periodic_runs", f"""
    WITH d AS (SELECT doc_id, {_CRC32} AS h, list_filter(
                   regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    c AS (SELECT doc_id, h % 10 = 0 AND len(w) > 0 AS edited, w, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a,
                 3 + (h // 10) % 8 AS parts FROM d),
    e AS (SELECT doc_id, n, CASE WHEN edited THEN w[1:a] || list_transform(range(0, n - a), lambda i:
                     w[a + i % (1 + (n - a) // parts) + 1]) ELSE w END AS w FROM c),
    i AS (SELECT doc_id, n, w, unnest(range(0, n - {_GRAM} + 1)) AS i FROM e),
    g AS (SELECT doc_id, n, i, array_to_string(w[i + 1:i + {_GRAM}], ' ') AS gram FROM i),
    m AS (SELECT x.doc_id, y.i - x.i AS q, y.i AS i FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.gram = y.gram
          AND x.i < y.i AND {_TIMES} * (y.i - x.i) <= x.n),
    s AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS run FROM m),
    v AS (SELECT doc_id, q, min(i) - q AS start, count(*) + {_GRAM - 1} + q AS length FROM s GROUP BY doc_id, q, run),
    r AS (SELECT doc_id, start, length, min(q) AS period FROM v WHERE length >= greatest({_LEAST}, {_TIMES} * q)
          GROUP BY doc_id, start, length),
    a AS (SELECT doc_id, count(*) AS n_runs,
                 string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS said FROM r GROUP BY doc_id),
    b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) AS k FROM r),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
    o AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, n)) AS i FROM e),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM o ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT e.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, (1000 * length) // period AS exponent_milli,
           sha256(coalesce(said, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM e LEFT JOIN a ON a.doc_id = e.doc_id LEFT JOIN b ON b.doc_id = e.doc_id AND b.k = 1
           LEFT JOIN kept ON kept.doc_id = e.doc_id""")
def runs_of_documents(spark, folder):
    return run_digests(with_repeats(table(spark, folder, "documents")))


def with_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in a tenth of the documents, by checksum, all words from one on repeat with one period."""
    code = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       code.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    begin = F.expr("cast((h div 10) % size(words) as int)")
    size = F.size("words") - begin
    period = (F.floor(size / F.expr("3 + (h div 10) % 8")) + 1).cast("int")
    edited = F.concat(F.slice("words", F.lit(1), begin), F.transform(
        F.sequence(F.lit(0), size - 1), lambda i: F.get("words", begin + i % period)))
    return rows.select("doc_id", F.when(F.size("words") > 0, F.array_join(edited, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """Runs of each document: their number, the one with the most periods, and digests of all and of what is kept."""
    none = F.expr("cast(null as struct<start: bigint, length: bigint, period: bigint>)")
    best = F.aggregate("runs", none, lambda most, run: F.when(
        most.isNull() | (run["length"] * most["period"] > most["length"] * run["period"]), run).otherwise(most))
    said = F.transform("runs", lambda run: F.concat(
        F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return periodic_runs.collapsed(docs).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(said, ""), 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))
