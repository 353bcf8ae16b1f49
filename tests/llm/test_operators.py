"""The training-data operators against brute force on small, awkward tables."""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pricewright.llm import (
    content_sort,
    language,
    mixing,
    multiset_hash,
    near_dup,
    packing,
    queries,
    site_lines,
    substrings,
    token_files,
    warc,
)
from pricewright.llm.queries import BYTE_BPE, WORD_BPE
from pricewright.llm.tokens import Encoder

WORDS = [f"w{i}" for i in range(400)]
SCHEMA = "doc_id long, text string, lang string, source string, text_sha256 string, salt int, place long"


def words(seed: int, count: int) -> str:
    return " ".join(np.random.default_rng(seed).choice(WORDS, count))


def awkward() -> list[tuple]:
    """Nulls, blanks, short and long texts, copies, near copies, repeated passages, and clashing column names."""
    base, passage = words(1, 300), words(2, 60)
    near = base.split()
    near[150] = "changed"
    texts = [None, "", "   \n", "one", "One", "a b c d", "A  b\nc d", base, base, base.upper(), " ".join(near),
             words(3, 80) + " " + passage + " " + words(4, 40), passage + "\n" + words(5, 50), "x " * 200, words(6, 5000),
             "Grüße naïve – 日本 語", "tab\tand\r\nline", "<|endoftext|> special", words(7, 34), words(7, 34), words(8, 35)]
    return [(3 * i + 1, text, ["en", "fr", None][i % 3], [None, "s0", "s0", "s1"][i % 4], "x", 1, 2)
            for i, text in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def repeated(spark):
    """Rows that repeat, and rows without an identifier."""
    rows = awkward()
    return spark.createDataFrame([*rows, *rows[5:9], (None, words(1, 300), "en", "s0", "x", 1, 2)], SCHEMA)


def lower(text: str | None) -> str:
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def split(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", text or "")


# exact copies

def test_equal_texts(docs):
    groups = defaultdict(list)
    for doc_id, text, *_ in awkward():
        groups[lower(text)].append(doc_id)
    want = {i: (max(ids), len(ids), i == max(ids), hashlib.sha256(text.encode()).hexdigest())
            for text, ids in groups.items() for i in ids}
    got = {r[0]: tuple(r)[1:] for r in content_sort.equal_texts(docs).collect()}
    assert got == want


def test_a_group_over_many_parts_and_batches(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = spark.range(600).select(
            F.col("id").alias("doc_id"),
            F.when(F.col("id") % 3 == 0, "Hot Text").otherwise(F.concat(F.lit("t"), F.col("id") % 50)).alias("text"))
        got = content_sort.equal_texts(rows)
        assert got.filter("kept").count() == 51
        assert got.filter("doc_id % 3 = 0").select("keep_id", "group_size").distinct().collect() == [(597, 200)]
        stay = content_sort.without_copies(rows)
        assert stay.columns == ["doc_id", "text"] and stay.count() == 51
        assert stay.filter("text = 'Hot Text'").first()["doc_id"] == 597
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def test_of_rows_that_repeat_an_identifier_one_stays(repeated):
    got = content_sort.equal_texts(repeated)
    assert got.count() == len(awkward()) + 5
    assert got.filter("kept").groupBy("text_sha256").count().filter("count <> 1").count() == 0
    assert content_sort.without_copies(repeated).count() == got.filter("kept").count()


# tokens, packing, token files

@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_parts_encode_as_the_library_does(path):
    random = np.random.default_rng(5)
    signs = list("aB1_'. \n\té²ßŁ-’ śİȺ語́\x1c")
    texts = ["".join(random.choice(signs, random.integers(0, 30))) for _ in range(3000)]
    texts += [f"a{chr(c)}b {chr(c)}1 {chr(c)}" for c in [*range(0x250), *range(0x2010, 0x20C0)]]
    texts += ["don't DON'T 'S x'S", "<|endoftext|> x <|startoftext|>", "a  b", " a ", "\r\n a\r\nb", "don''t's"]
    model = Encoder(path)
    assert model.encode(texts) == model._encode(texts)
    assert model.encode(texts) == model._encode(texts)


def tokens(path: str, end: int) -> dict[int, list[int]]:
    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    return {i: [*model.encode(text or "", add_special_tokens=False).ids, end] for i, text, *_ in awkward()}


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("limits", [
    packing.Capacity(), packing.Capacity(tokens=256, documents=3, score="dot"),
    packing.Capacity(tokens=128, attention=6000.0)])
def test_packing_keeps_every_limit(docs, limits):
    capacity = limits
    if capacity.attention is not None:  # a whole piece must fit
        capacity = packing.Capacity(tokens=64, attention=64.0 ** 2)
    ids = tokens(BYTE_BPE, 2)
    rows = packing.packed_documents(docs, BYTE_BPE, 2, capacity).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        assert crc(ids[r.doc_id][r.start:r.start + r.length]) == r.ids_crc32
        pieces[r.doc_id].append((r.piece, r.start, r.length))
        bins[r.sequence_id].append((r.offset, r.length))
    for doc_id, parts in pieces.items():
        parts.sort()
        assert [p[0] for p in parts] == list(range(len(parts)))
        assert sum(p[2] for p in parts) == len(ids[doc_id])
        assert all(p[2] == capacity.tokens for p in parts[1:])
    assert pieces.keys() == ids.keys()
    for parts in bins.values():
        parts.sort()
        ends = np.cumsum([n for _, n in parts])
        assert [o for o, _ in parts] == [0, *ends[:-1]] and ends[-1] <= capacity.tokens
        assert len(parts) <= capacity.documents
        assert capacity.attention is None or sum(n * n for _, n in parts) <= capacity.attention


def test_ranges_of_bins_are_what_piece_by_piece_gives():
    random = np.random.default_rng(3)
    for score in ("norm", "dot"):
        limits = packing.Capacity(tokens=40, documents=5, score=score)
        counts = Counter(int(n) for n in random.integers(1, 41, 300))
        plan = packing.best_fit(counts, limits)
        full = np.array([40.0, 5.0, 1600.0])
        bins: list[np.ndarray] = []
        for length in sorted(counts, reverse=True):
            demand = np.array([length, 1.0, length * length])
            for _ in range(counts[length]):
                scores = [np.inf if (rest < demand).any() else
                          (rest / full) @ (np.array(limits.weights) * demand / full) if score == "dot" else
                          np.sqrt((np.array(limits.weights) * ((rest - demand) / full) ** 2).sum()) for rest in bins]
                if not scores or min(scores) == np.inf:
                    bins.append(full.copy())
                    scores.append(0.0)
                    scores[:-1] = [np.inf] * (len(scores) - 1)
                bins[int(np.argmin(scores))] -= demand
        assert int(plan["sequences"][0]) == len(bins)


def test_sequences_hold_the_ids(docs):
    ids = tokens(BYTE_BPE, 2)
    rows = packing.packed_documents(docs, BYTE_BPE, 2, keep_ids=True)
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(rows).collect()}
    for r in rows.collect():
        assert whole[r.sequence_id][r.offset:r.offset + r.length] == ids[r.doc_id][r.start:r.start + r.length]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, docs, tmp_path, encoding):
    folder = str(tmp_path / "tokens")
    token_files.write_token_files(docs, folder, WORD_BPE, 1, encoding, page_rows=2)
    ids, want, at = tokens(WORD_BPE, 1), [], 0
    for doc_id in sorted(ids):
        want.append((doc_id, at, len(ids[doc_id]), crc(ids[doc_id])))
        at += len(ids[doc_id])
    read = token_files.read_token_files(spark, folder)
    assert sorted(tuple(r) for r in token_files.token_spans(read).collect()) == want
    assert read.filter("doc_id = 22").select("ids").first()[0] == ids[22]
    files = [pq.ParquetFile(path) for path in (tmp_path / "tokens").glob("*.parquet")]
    columns = [f.metadata.row_group(0).column(4) for f in files if f.metadata.num_row_groups]
    assert all(c.has_offset_index for c in columns)
    sort = "RLE_DICTIONARY" if encoding == "dictionary" else "DELTA_BINARY_PACKED"
    assert all(sort in c.encodings or (encoding == "dictionary" and "PLAIN_DICTIONARY" in c.encodings) for c in columns)


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_added_tokens_have_their_ids(path):
    texts = ["a <|endoftext|> b", "x<|startoftext|>y", "<|endoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endof text|>", "語 <|endoftext|>",
             "", "plain words, don't", " <|endoftext|> ", "<| endoftext |>"]
    want = [Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids for text in texts]
    model = Encoder(path, added=True)
    assert [np.frombuffer(one, "<u4").tolist() for one in model.encode(texts)] == want


def test_queries_give_added_tokens_their_ids(spark, tmp_path):
    text = "a <|endoftext|> b <|startoftext|> c"
    row = (1, text, "en", "s0", len(text))
    spark.createDataFrame([row], "doc_id long, text string, lang string, source string, n_chars long").toPandas().to_parquet(
        tmp_path / "documents.parquet")
    for run, path, end in ((queries.token_list_files, WORD_BPE, 1), (queries.best_fit_packing, BYTE_BPE, 2),
                           (lambda spark, folder: corpus_pipeline.training_sequences(
                               spark, spark.read.parquet(f"{folder}/documents.parquet"), folder), BYTE_BPE, 2)):
        ids = [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, end]
        assert [r.ids_crc32 for r in run(spark, str(tmp_path)).collect()] == [crc(ids)]


# archives

@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_any_identifier_has_a_capture_time_in_any_zone(spark, tmp_path, zone):
    rows = [(2 ** 60, "http://a.org", "x" * 1200, "u", 1), (-5, "http://a.org", "x" * 1200, "u", 1), (3 * 10 ** 11, "http://a.org", "y", "u", 1),
            (None, "http://a.org", "z", "u", 1), (7, "http://b.org", "z", "u", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, urlkey string, same int").repartition(3)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        index = warc.merged_index(warc.write_archives(pages, str(tmp_path / "fixed"))).orderBy("index_place").collect()
        assert [r.page_id for r in index] == [None, -5, 3 * 10 ** 11, 2 ** 60, 7]
        assert {r.taken for r in index} == {warc.CAPTURE_TIME}
        times = F.timestamp_seconds(F.lit(1541296800) + F.col("page_id") % 10)  # a night without midnight in one of the zones
        index = warc.merged_index(warc.write_archives(pages, str(tmp_path / "own"), taken=times)).collect()
        got = {r.page_id: r.taken for r in index}
        assert got == {2 ** 60: "20181104020006", -5: "20181104015955", 3 * 10 ** 11: "20181104020000", 7: "20181104020007",
                       None: warc.CAPTURE_TIME}
        read = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_archives(
            warc.merged_index(warc.write_archives(pages, str(tmp_path / "two"))), str(tmp_path / "two")).collect()}
        assert read[-5] == ("revisit", 2 ** 60) and read[2 ** 60] == ("response", None)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_archives_round_trip(spark, tmp_path):
    page = "<p>" + "x" * 1200
    rows = [(1, "http://a.org/x", page), (2, "https://www.A.org:80/x#f", page), (3, None, None), (4, "no address", "short"),
            (5, "http://b.org", "short"), (6, "http://a.org/x", page), (7, "http://a.org/x?q=1", "ü" * 600),
            (8, "http://a.org/x", "\r\n\r\nWARC/1.1\r\n" + "y" * 1000), (9, "http://a.org/\r\nx: y", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    folder = str(tmp_path / "warc")
    index = warc.merged_index(warc.write_archives(pages, folder))
    got = {r.page_id: r for r in warc.read_archives(index, folder).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items() if r.record_type == "revisit"} == {
        1: ("revisit", 6), 2: ("revisit", 6)}
    for page_id, _, html in rows:
        data = (html or "").encode()
        assert got[page_id].payload_bytes == len(data)
        assert got[page_id].payload_digest == hashlib.sha1(data).hexdigest()
        assert got[page_id].payload == (None if page_id in (1, 2) else data)
    order = [(r.urlkey, r.page_id, r.capture_no) for r in index.orderBy("index_place").collect()]
    assert [o[:2] for o in order] == sorted((o[:2] for o in order), key=lambda o: (o[0].encode(), o[1]))
    assert [o[2] for o in order if o[0] == "org,a)/x"] == [0, 1, 2, 3]


def test_loser_tree():
    random = np.random.default_rng(1)
    for count in range(12):
        lists = [sorted(random.integers(0, 20, random.integers(0, 6)).tolist()) for _ in range(count)]
        merged = [lists[source][step] for source, step in warc.LoserTree(lists)]
        assert merged == sorted(value for one in lists for value in one)


# lines

def test_lines_above_the_ratio_go(spark):
    pages = [(i, f"http://h.org/{i}", f"<body><div>menu</div><p>own {i}</p><p>twice</p></body>" if i < 2 else
              f"<div>menu</div><script><p>no</p></script><p>own <b>{i}</b></p>") for i in range(12)]
    pages += [(20, "http://other.org", "<div>menu</div>"), (21, None, None), (22, "x", " menu ")]
    got = {r.page_id: r for r in site_lines.without_boilerplate(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert len(got) == 15
    assert got[0].kept == "own 0\ntwice" and got[0].n_dropped == 1 and got[5].kept == "own 5"
    assert got[20].kept == "menu" and got[21].n_lines == 0 and got[22].kept == "menu" and got[22].host == ""


# fingerprints

def test_fingerprints_add_and_forget_order():
    a, b, c = "first line\n", "second one here\n", "third"
    of = multiset_hash.Fingerprint.of
    assert str(of(a + b + c)) == str(of(c + "\n" + a + "\n" + b)) == str(of(a) + of(b) + of(c))
    assert str(of(a + b + c) - of(b)) == str(of(a + c)) and str(of(a + a)) != str(of(a))
    assert str(of("")) == str(multiset_hash.Fingerprint())


def test_edited_texts(docs, repeated):
    rows = sorted((i, t or "") for i, t, *_ in awkward())
    got = {r.doc_id: r for r in multiset_hash.edited_likeness(docs).collect()}
    for n, (doc_id, text) in enumerate(rows):
        edited = multiset_hash.edited_text(text, rows[(n + 1) % len(rows)][1])
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == str(multiset_hash.Fingerprint.of(text))
        assert r.edited_fingerprint == str(multiset_hash.Fingerprint.of(edited))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert multiset_hash.edited_likeness(repeated).count() == len(rows) + 5
    assert multiset_hash.edited_likeness(docs.filter("doc_id = 22")).first()["near_next"] == 1.0


@pytest.mark.parametrize("low", [1 << 60, (1 << 63) - 3001, -(1 << 63)])
def test_no_document_is_left_out_at_large_identifiers(spark, low):
    ids = [low + 3 * n + 1 for n in range(1000)]
    docs = spark.createDataFrame([(i, f"text {i}\nend {i % 7}") for i in ids], "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.edited_sha256 for r in multiset_hash.edited_likeness(docs).collect()}
    assert got == {i: hashlib.sha256(multiset_hash.edited_text(f"text {i}\nend {i % 7}", f"text {j}\nend {j % 7}").encode()).hexdigest()
                   for i, j in zip(ids, [*ids[1:], ids[0]], strict=True)}


# languages

def test_language_on_held_out_rows(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identified(rows).join(rows.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 200 and np.mean([r.lang == r.lang_pred for r in got]) > 0.95


def test_language_of_odd_texts(docs, empty):
    got = {r.doc_id: r for r in language.identified(docs).collect()}
    assert len(got) == len(awkward())
    assert {got[i].lang_pred for i in (1, 4, 7)} == {"und"} and got[1].score == 0
    assert {r.lang_pred for r in got.values()} <= {"und", "en", "fr"}
    assert got[10].held_out == (zlib.crc32(b"10") % 4 == 2)
    nothing = language.identified(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    stay = language.with_language(docs, 0.0)
    assert stay.columns == docs.columns and stay.filter("doc_id IN (1, 4, 7)").count() == 0


# near copies

def links_by_force(rows, per_cent: int) -> dict[int, int]:
    sets, parent = {}, {}
    for doc_id, text in rows:
        own = split(lower(text))
        sets[doc_id] = set(zip(*(own[i:] for i in range(5)))) if len(own) > 4 else {tuple(own)} if own else set()
        parent[doc_id] = doc_id

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for doc_id in sorted(sets):
        for shingle in sets[doc_id]:
            where[shingle].append(doc_id)
    common = Counter((a, b) for ids in where.values() for i, a in enumerate(ids) for b in ids[i + 1:])
    for (a, b), n in common.items():
        if 100 * n >= per_cent * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def test_links_equal_brute_force(docs, repeated):
    want = links_by_force([(i, t) for i, t, *_ in awkward()], 85)
    assert {r[0]: tuple(r)[1:] for r in near_dup.linked(docs).collect()} == want
    again = near_dup.linked(repeated).collect()
    assert len(again) == len(want) + 5 and all(tuple(r)[1:] == want[r.doc_id] for r in again if r.doc_id is not None)


def test_chains_of_near_copies_and_near_misses(spark, monkeypatch):
    """A family whose members differ by growing amounts: some pairs link, others just miss, chains connect."""
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    random, rows = np.random.default_rng(9), []
    for family in range(6):
        text = words(50 + family, 200).split()
        for step in range(25):
            for place in random.integers(0, 200, 1 + family):
                text[place] = f"n{family}_{step}_{place}"
            rows.append((len(rows), " ".join(text)))
    random.shuffle(rows)
    rows = [(i, text) for i, (_, text) in enumerate(rows)]
    got = {r[0]: tuple(r)[1:] for r in near_dup.linked(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == links_by_force(rows, 85)


@pytest.mark.parametrize("per_cent", [80, 85])
def test_one_outsider_costs_a_row_a_member(spark, monkeypatch, per_cent):
    """Near copies of one text and a far copy: block rows stay in proportion to the members, no link is lost."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    counts, found = [], near_dup.block_rows
    monkeypatch.setattr(near_dup, "block_rows", lambda left: counts.append(
        (left.count(), found(left).count())) or found(left))
    for count in (60, 180):
        random, text = np.random.default_rng(4), words(77, 200).split()
        rows = [(i, " ".join([*text[:at], f"n{i}", *text[at + 1:]])) for i, at in enumerate(random.integers(0, 200, count))]
        rows.append((count, " ".join(f"far{at}" if at % 17 == 3 else w for at, w in enumerate(text))))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r[0]: tuple(r)[1:] for r in near_dup.linked(docs, per_cent).collect()}
        assert got == links_by_force(rows, per_cent)
    assert all(made <= near_dup.MOST_BLOCK_ROWS * members for members, made in counts)


def test_rows_that_repeat_an_identifier_are_linked_by_their_own_text(spark):
    text, other = words(90, 60), words(91, 60)
    rows = [(5, other), (5, text), (7, text + " more"), (9, text + " again"), (9, words(92, 60))]
    for order in (rows, [rows[1], rows[0], *rows[2:]]):
        docs = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        got = Counter((r.doc_id, r.component_id, r.kept) for r in near_dup.linked(docs).collect())
        assert got == Counter([(5, 5, True), (5, 5, True), (7, 5, False), (9, 5, False), (9, 9, True)])
        stay = near_dup.without_near_copies(docs).collect()
        assert sorted(tuple(r) for r in stay) == sorted([rows[0], rows[1], rows[4]])


def test_agreements_needed_follow_the_posterior():
    least = near_dup.least_agreements(85, 1e-6)
    assert len(least) == 7 and least == sorted(least) and 0 < least[0] < 16 * 0.85


# mixtures

def test_no_source_is_a_block_ahead_or_behind(spark):
    sizes = {"a": 9000, "b": 3000, "c": 500, None: 1200, "": 40}
    rows = spark.createDataFrame([(f"{name}", size) if name is not None else (None, size) for name, size in sizes.items()],
                                 "source string, size int")
    docs = rows.select("source", F.explode(F.sequence(F.lit(1), "size")).alias("n")).select(
        F.monotonically_increasing_id().alias("doc_id"), "source")
    got = mixing.mixed(docs, block_rows=4, period=100).collect()
    assert len(got) == sum(sizes.values()) and sorted(r.place for r in got) == list(range(len(got)))
    slots = {(r.source, r.block): (r.release, r.slot, r.deadline) for r in got}
    assert all(release <= slot < deadline for release, slot, deadline in slots.values())
    assert len({slot for _, slot, _ in slots.values()}) == len(slots)
    for name, size in sizes.items():
        taken = sorted(slot for (source, _), (_, slot, _) in slots.items() if source == name)
        blocks = -(-size // 4)
        assert len(taken) == blocks
        first = [r for r in got if r.source == name and r.block == 0][0]
        weight = 1 / (first.deadline - first.release) if blocks == 1 else None
        units = sum(slot < 100 for slot in taken) / 100 if weight is None and taken[-1] >= 100 else None
        if units:
            for done, slot in enumerate(taken):
                assert abs(done - units * slot) < 1 + 1e-9 and abs(done + 1 - units * (slot + 1)) < 1 + 1e-9


def test_large_sources_are_held_to_their_weight(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 > 0, "big").otherwise(
        F.concat(F.lit("s"), F.col("id") % 5)).alias("source"), F.lit("t").alias("text"))
    stay = mixing.to_weights(docs, 0.25)
    counts = {r.source: r["count"] for r in stay.groupBy("source").count().collect()}
    assert stay.columns == docs.columns and sum(n for name, n in counts.items() if name != "big") == 1000
    assert 900 <= counts["big"] <= 1100
    assert mixing.to_weights(docs.filter("source <> 'big'"), 0.25).count() == 1000


@pytest.mark.parametrize("sizes", [[700, 300], [500, 400, 350], [1000]])
def test_sources_that_are_all_large_end_with_the_first_to_run_out(spark, sizes):
    ends = np.cumsum(sizes)
    docs = spark.range(int(ends[-1])).select(
        F.col("id").alias("doc_id"), sum((F.col("id") >= int(end)).cast("int") for end in ends).cast("string").alias("source"))
    counts = {r.source: r["count"] for r in mixing.to_weights(docs, 0.25).groupBy("source").count().collect()}
    least = min(sizes)
    assert counts[str(sizes.index(least))] == least
    assert all(abs(count - least) <= mixing.BLOCK_ROWS for count in counts.values()) and len(counts) == len(sizes)


def test_many_sources_are_scheduled_in_seconds(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 300).cast("string").alias("source"),
                                    F.lit(1).alias("label"), F.lit(2).alias("units"))
    rows = mixing.mixed(docs).collect()
    assert len(rows) == 3000 and len({r.slot for r in rows}) == 300
    assert all(r.release <= r.slot < r.deadline for r in rows)


# repeated windows

def removed_by_force(rows) -> dict[int, tuple]:
    texts = [(i, split(text)) for i, text in rows]
    seen = Counter(tuple(own[at:at + 35]) for _, own in texts for at in range(len(own) - 34))
    out = {}
    for doc_id, own in texts:
        gone = [False] * len(own)
        for at in range(len(own) - 34):
            if seen[tuple(own[at:at + 35])] > 1:
                gone[at:at + 35] = [True] * 35
        out[doc_id] = (len(own), sum(gone), " ".join(w for w, g in zip(own, gone) if not g))
    return out


@pytest.mark.parametrize("block", [1, 1 << 21])
def test_repeated_windows_go(docs, block, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_BYTES", block)
    want = removed_by_force([(i, t) for i, t, *_ in awkward()])
    assert {r[0]: tuple(r)[1:] for r in substrings.without_repeats(docs).collect()} == want


def test_a_narrow_sketch_loses_nothing(docs, monkeypatch):
    monkeypatch.setattr(substrings, "_width", lambda windows: 64)
    want = removed_by_force([(i, t) for i, t, *_ in awkward()])
    assert {r[0]: tuple(r)[1:] for r in substrings.without_repeats(docs).collect()} == want


def test_buckets_and_slices_grow_with_the_input(spark, docs, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 1 << 12)
    monkeypatch.setattr(substrings, "SLICE_WINDOWS", 64)
    want = removed_by_force([(i, t) for i, t, *_ in awkward()])
    assert {r[0]: tuple(r)[1:] for r in substrings.without_repeats(docs).collect()} == want
    assert not [table for table in spark.catalog.listTables() if table.name.startswith("blocks_")]


# empty tables

@pytest.mark.parametrize("operator", [
    content_sort.equal_texts, content_sort.without_copies, near_dup.linked, near_dup.without_near_copies,
    multiset_hash.edited_likeness, multiset_hash.fingerprinted, language.identified, substrings.without_repeats,
    mixing.mixed, lambda d: mixing.to_weights(d, 0.25), lambda d: packing.packed_documents(d, BYTE_BPE, 2)])
def test_empty_tables_give_empty_results(empty, operator):
    assert operator(empty).count() == 0


def test_empty_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string, host string, lines string")
    assert site_lines.without_boilerplate(pages).count() == 0
    index = warc.merged_index(warc.write_archives(pages, str(tmp_path / "none")))
    assert warc.read_archives(index, str(tmp_path / "none")).count() == 0
    token_files.write_token_files(spark.createDataFrame([], SCHEMA), str(tmp_path / "tokens"), WORD_BPE, 1)
    assert token_files.token_spans(token_files.read_token_files(spark, str(tmp_path / "tokens"))).count() == 0


def test_documents_are_json_safe(docs):
    """Fingerprints are plain text."""
    assert json.dumps([r.fingerprint for r in multiset_hash.fingerprinted(docs).collect()])
