"""Near-duplicates by banded MinHash and sequential Bayesian verification.

A document's set is its distinct runs of five words (A to Z lower-cased). Texts that
are the same words in the same order are one class from the start and share one
signature. Documents that agree in a whole band are candidates. A candidate pair's
signatures are compared batch by batch: with a uniform prior, the similarity after m
of n agreements has a beta posterior, and the pair is dropped as soon as the
probability that it reaches the threshold falls below ``miss``. What survives is
confirmed on the full sets.

Only connections count, so a bucket's classes are first compared with one leader.
While many of a bucket are outside its largest component, they are compared with
another member of it, one in each bucket and turn. What is still outside then meets
the whole bucket, block by block, while the members of the largest component have a
row each and do not meet: every pair of a bucket is either compared or already
connected, no pair leaves its task unless it joins two components, no bucket is cut.
With 28 bands of 4 a pair at the threshold of 0.85 is no candidate with probability 1e-9.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm.common import checked, salted_left_join, salts_of_large_keys, texts, whole, worker_store
from pricewright.llm.components import components
from pricewright.llm.words import _LOWER, _WORD_BASE, Words, mixed, pieces_of, span_hashes
from pricewright.session import staged

SHINGLE = 5
PER_CENT = 85
BANDS, ROWS = 28, 4
BATCH = 16
MISS = 1e-6
BLOCK = 512
PIECE_BYTES = 1 << 18  # of texts signed at once; the numbers of their words and runs take many times that
MOST_BLOCK_ROWS, STARS_WHILE = 2, 0.9  # rows a member before stars are tried, and while they connect a tenth
_HASHES = BANDS * ROWS
_RANDOM = np.random.default_rng(20240229)
_FACTORS = (_RANDOM.integers(0, 1 << 31, _HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_SHIFTS = _RANDOM.integers(0, 1 << 32, _HASHES, dtype=np.uint32)[:, None]
_SLICE = 4096


def least_agreements(per_cent: int = PER_CENT, miss: float = MISS, batch: int = BATCH) -> list[int]:
    """For each number of compared hashes, the fewest agreements that keep a pair.

    After m of n the similarity has density Beta(m + 1, n - m + 1), and its chance to
    reach t is that of at most m successes in n + 1 trials at t.
    """
    t, out = per_cent / 100, []
    for n in range(batch, _HASHES + 1, batch):
        chance, m = 0.0, -1
        while chance < miss:
            m += 1
            chance += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash over the set."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(_HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(values), _SLICE):
        np.minimum(least, (_FACTORS * values[start:start + _SLICE] + _SHIFTS).min(axis=1), out=least)
    return least


_SIGNED = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                     ("bands", pa.list_(pa.int64())), ("hashes", pa.binary())])
_SIGNED_DDL = "doc_id long, mark long, n_shingles long, digest binary, bands array<long>, hashes binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_store("near_dup")  # nothing is kept, but an encoder of some 100 MB goes
    number = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for batch in batches:
        keys, marks, column = batch.column("doc_id"), batch.column("mark"), batch.column("text")
        for row, data, offsets in pieces_of(column, PIECE_BYTES):
            words = Words(data, offsets, lower=True)
            hashes = words.hashes()
            counts = np.diff(words.first)
            grams, _ = words.grams(hashes, SHINGLE)
            bounds = np.concatenate([[0], np.cumsum(np.maximum(counts - SHINGLE + 1, 0))])
            raw = words.data.tobytes()
            sizes, digests, bands, signs = [], [], [], []
            for i, count in enumerate(counts):
                if not count:
                    sizes.append(0)
                    digests.append(None)
                    bands.append(None)
                    signs.append(None)
                    continue
                if count < SHINGLE:
                    own = span_hashes(hashes, words.first[i:i + 1], words.first[i + 1:i + 2], _WORD_BASE)
                else:
                    own = np.unique(grams[bounds[i]:bounds[i + 1]])
                least = signature(own)
                four = least.reshape(BANDS, ROWS).astype(np.uint64)
                key = number.copy()
                for at in range(ROWS):
                    key = mixed(key * np.uint64(31) + four[:, at])
                sizes.append(len(own))
                digests.append(hashlib.blake2b(b" ".join(raw[offsets[i]:offsets[i + 1]].split()), digest_size=16).digest())
                bands.append(key.view(np.int64))
                signs.append((least >> np.uint32(16)).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([
                keys.slice(row, len(counts)), marks.slice(row, len(counts)), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())), pa.array(signs, pa.binary())], schema=_SIGNED)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(-1, _HASHES)


def _likely(per_cent: int, miss: float):
    """Pairs with both signatures to the pairs that survive the comparison batch by batch."""
    least = least_agreements(per_cent, miss)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_store("near_dup")
        for batch in batches:
            if not len(batch):
                continue
            one, two = _matrix(batch.column("hashes_a")), _matrix(batch.column("hashes_b"))
            alive, agreed = np.arange(len(one)), np.zeros(len(one), dtype=np.int64)
            for step, need in enumerate(least):
                part = slice(step * BATCH, (step + 1) * BATCH)
                agreed = agreed + (one[alive, part] == two[alive, part]).sum(axis=1)
                stay = agreed >= need
                alive, agreed = alive[stay], agreed[stay]
            at = pa.array(alive)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])

    return apply


class _Forest:
    def __init__(self, count: int):
        self.parent = list(range(count))

    def root(self, node: int) -> int:
        while self.parent[node] != node:
            self.parent[node] = self.parent[self.parent[node]]
            node = self.parent[node]
        return node

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _apart(per_cent: int, miss: float, confirm: bool):
    """Two blocks of a bucket's documents, each pair of blocks once, compared across components.

    A pair belongs to the bucket of its first common band. Without ``confirm`` the
    documents of likely pairs come back, with it (and their words) the pairs that
    hold on the full sets and join components.
    """
    least = least_agreements(per_cent, miss)

    def apply(key: tuple, rows: pa.Table) -> pa.Table:
        bucket, first, second = (part.as_py() for part in key)
        block = rows["block"].to_numpy()
        ids, labels = rows["node"].to_numpy(), rows["component"].to_numpy()
        matrix = _matrix(rows["hashes"].combine_chunks())
        bands = rows["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        words = rows["words"].to_pylist() if confirm else []
        small: dict[int, np.ndarray] = {}
        _, of = np.unique(labels, return_inverse=True)
        forest = _Forest(int(of.max()) + 1)
        pairs, used = [], np.zeros(len(ids), dtype=bool)

        def holds(x: int, y: int) -> bool:
            for one in (x, y):
                if one not in small:
                    small[one] = _shingle_hashes(words[one])
            one, two = small[x], small[y]
            both = len(np.intersect1d(one, two, assume_unique=True))
            if 100 * both < per_cent * (len(one) + len(two) - both):
                return False
            return similar(shingle_set(words[x]), shingle_set(words[y]), per_cent)

        for start in range(0, len(left), 64):
            at = left[start:start + 64]
            open_pair = labels[at][:, None] != labels[right][None, :]
            if first == second:
                open_pair &= at[:, None] < right[None, :]
            x, y = np.nonzero(open_pair)
            x, y = at[x], right[y]
            agreed = np.zeros(len(x), dtype=np.int64)
            for step, need in enumerate(least):
                part = slice(step * BATCH, (step + 1) * BATCH)
                agreed = agreed + (matrix[x, part] == matrix[y, part]).sum(axis=1)
                stay = agreed >= need
                x, y, agreed = x[stay], y[stay], agreed[stay]
            common = bands[x] == bands[y]
            own = bands[x, common.argmax(axis=1)] == bucket
            x, y, agreed = x[own], y[own], agreed[own]
            used[x] = used[y] = True
            if confirm:
                for i in np.argsort(-agreed, kind="stable"):
                    one, two = int(of[x[i]]), int(of[y[i]])
                    if forest.root(one) != forest.root(two) and holds(int(x[i]), int(y[i])):
                        forest.join(one, two)
                        pairs.append((ids[x[i]], ids[y[i]]))
        if confirm:
            return pa.table({name: pa.array([pair[i] for pair in pairs], pa.int64()) for i, name in enumerate("ab")})
        return rows.filter(pa.array(used)).select(["bucket", "one", "two", "block", "node", "component"])

    return apply


def _shingle_hashes(words: str) -> np.ndarray:
    data = words.encode()
    cut = Words(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
    hashes = cut.hashes()
    return np.unique(cut.grams(hashes, min(SHINGLE, len(hashes)))[0]) if len(hashes) else np.zeros(0, dtype=np.uint64)


def similar(one: set, two: set, per_cent: int) -> bool:
    both = len(one & two)
    return 100 * both >= per_cent * (len(one) + len(two) - both)


def shingle_set(text: str) -> set:
    words = text.split(" ")
    if len(words) < SHINGLE:
        return {tuple(words)} if text else set()
    return set(zip(*(words[at:] for at in range(SHINGLE)), strict=False))


def _confirm(per_cent: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_store("near_dup")
        held, one = None, set()
        for batch in batches:
            out = []
            for a, b, text_a, text_b in zip(*(batch.column(name).to_pylist() for name in (
                    "a", "b", "words_a", "words_b")), strict=True):
                if a != held:
                    held, one = a, shingle_set(text_a)
                if similar(one, shingle_set(text_b), per_cent):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([pair[i] for pair in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return apply


def _plain_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as their lower-cased words joined by single spaces."""
    table = bytes(_LOWER)
    for batch in batches:
        plain = [b" ".join(text.encode().translate(table).split()) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(plain, pa.binary()).cast(pa.string())], names=["node", "words"])


def _words_of(rows: DataFrame, speakers: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, words``: the words of these classes' speakers, written once."""
    wanted = staged(speakers.select("node", "doc_id", "mark").join(nodes.distinct(), "node", "left_semi"), "wanted")
    found = rows.join(checked(wanted), ["doc_id", "mark"]).dropDuplicates(["node"])
    return staged(found.mapInArrow(_plain_words, "node long, words string"), "words")


def _verified(pairs: DataFrame, rows: DataFrame, speakers: DataFrame, per_cent: int, miss: float) -> DataFrame:
    """The pairs (``a`` the leader, ``b``) that survive batch by batch and whose full sets are similar enough.

    A leader has as many pairs as its buckets have members, so its pairs are dealt out by ``b``.
    """
    salts = salts_of_large_keys(staged(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")), "leaders"), "a", "n")
    hashes = speakers.select("node", "hashes")
    paired = salted_left_join(pairs, hashes.toDF("a", "hashes_a"), "a", salts, "b").join(hashes.toDF("b", "hashes_b"), "b")
    likely = staged(paired.mapInArrow(_likely(per_cent, miss), "a long, b long"), "likely")
    words = _words_of(rows, speakers, likely.select(F.explode(F.array("a", "b")).alias("node")))
    one, two = (words.toDF(side, f"words_{side}") for side in "ab")
    both = salted_left_join(likely.join(two, "b"), one, "a", salts, "b").sortWithinPartitions("a")
    return staged(both.mapInArrow(_confirm(per_cent), "a long, b long"), "confirmed")


def _split(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, with the bucket's largest one (``main``).

    ``inside`` and ``outside`` count the bucket's members within and without it.
    """
    at = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    at = staged(at, "labelled")
    counts = at.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("size"))
    sizes = staged(sizes.filter("most.n < size").select(
        "bucket", "size", F.col("most.component").alias("main"), F.col("most.n").alias("inside"),
        (F.col("size") - F.col("most.n")).alias("outside")), "split")
    salts = salts_of_large_keys(sizes, "bucket", "size")
    return staged(salted_left_join(at, sizes.drop("size"), "bucket", salts, "node").filter("main IS NOT NULL"), "open")


def _next_stars(open_members: DataFrame, turn: int) -> DataFrame:
    """Pairs of a bucket's members outside its largest component with one member of it, another in each bucket and turn."""
    lot = F.xxhash64("node", "bucket", F.lit(turn))
    heads = open_members.filter("component = main").groupBy("bucket").agg(F.min(F.struct(lot, "node"))["node"].alias("a"))
    return open_members.filter("component <> main").join(heads, "bucket").select("a", F.col("node").alias("b")).distinct()


def _blocks() -> tuple[Column, Column, Column]:
    """Blocks of the largest component and of the others, and whether a member is of the largest."""
    main, rest = (F.ceil(F.col(part) / BLOCK).cast("int") for part in ("inside", "outside"))
    return main, rest, F.col("component") == F.col("main")


def block_rows(open_members: DataFrame) -> DataFrame:
    """``bucket, one, two, block, node, component``: each pair of blocks that has to meet, with its members.

    Members of the largest component only meet blocks of the others, so each of them
    has one row while the others fill one block; the others meet every block.
    """
    main, rest, inner = _blocks()
    lot = F.xxhash64("node")
    return (
        open_members
        .withColumn("block", F.when(inner, F.pmod(lot, main)).otherwise(main + F.pmod(lot, rest)).cast("int"))
        .withColumn("mate", F.explode(F.sequence(F.when(inner, main).otherwise(F.lit(0)), main + rest - 1)))
        .select("bucket", F.least("block", "mate").alias("one"), F.greatest("block", "mate").alias("two"),
                "block", "node", "component"))


def linked(docs: DataFrame, per_cent: int = PER_CENT, miss: float = MISS,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Documents with ``100 * common >= per_cent * all`` shingles are linked;
    ``component_id`` is the smallest identifier reachable. A text of fewer than five
    words is one shingle; null, empty and blank texts have none and stand alone.
    Rows that repeat an identifier each have the result of their own text. A null
    identifier stands alone and is kept. An empty table gives an empty result.
    """
    return _linked(docs, per_cent, miss, key, text).drop("mark")


def _linked(docs: DataFrame, per_cent: int, miss: float, key: str, text: str) -> DataFrame:
    """As ``linked``, with the ``mark`` of each row's text."""
    rows = texts(docs, key, text).withColumn("mark", F.xxhash64("text"))
    signed = staged(rows.mapInArrow(_sign, _SIGNED_DDL), "signatures")
    classes = staged(signed.filter("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("first")), "classes")
    speakers = signed.select("doc_id", "mark", "digest", "bands", "hashes").join(
        classes.select("digest", F.col("first").alias("doc_id")), ["digest", "doc_id"], "left_semi")
    # numbers of the classes; the table is written once, so they stay
    speakers = staged(speakers.dropDuplicates(["digest"]).withColumn("node", F.monotonically_increasing_id()), "speakers")

    buckets = speakers.select("node", F.explode("bands").alias("bucket"))
    leaders = staged(buckets.groupBy("bucket").agg(
        F.min("node").alias("leader"), F.count(F.lit(1)).alias("size")).filter("size > 1"), "leaders")
    salts = salts_of_large_keys(leaders, "bucket", "size")
    members = staged(salted_left_join(buckets, leaders.drop("size"), "bucket", salts, "node").filter(
        "node <> leader").select("bucket", "node", "leader"), "members")
    stars = members.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = _verified(stars, rows, speakers, per_cent, miss)
    members = members.drop("leader")
    main, rest, inner = _blocks()
    outside, turn = None, 0
    while True:
        labels = components(links)
        left = _split(members, labels)
        size, cost, apart = left.agg(
            F.count(F.lit(1)), F.sum(F.when(inner, rest).otherwise(main + rest)), F.sum((~inner).cast("long"))).first()
        if not size or cost <= MOST_BLOCK_ROWS * size or outside is not None and apart > outside * STARS_WHILE:
            break
        outside = apart
        turn += 1
        links = links.union(_verified(_next_stars(left, turn), rows, speakers, per_cent, miss))

    blocks = staged(block_rows(left), "blocks")
    signs = speakers.select("node", "hashes", "bands")
    by_block = ["bucket", "one", "two"]
    apart = staged(blocks.join(signs, "node").groupBy(*by_block).applyInArrow(
        _apart(per_cent, miss, confirm=False), blocks.schema), "apart")
    words = _words_of(rows, speakers, apart.select("node"))
    more = apart.join(signs, "node").join(words, "node").groupBy(*by_block).applyInArrow(
        _apart(per_cent, miss, confirm=True), "a long, b long")
    labels = components(links.union(staged(more, "more")))

    placed = staged(speakers.join(labels, "node", "left").select(
        "digest", "doc_id", F.coalesce("component", "node").alias("component")), "placed")
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(least, "component").select("digest", "component_id")
    return signed.select("doc_id", "mark", "n_shingles", "digest").join(named, "digest", "left").select(
        "doc_id", "mark", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))


def without_near_copies(docs: DataFrame, per_cent: int = PER_CENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, one of each component, with the columns of the input.

    Of rows that repeat an identifier only those go whose own text is a near copy.
    """
    gone = staged(_linked(docs, per_cent, MISS, key, text).filter("NOT kept").select(
        F.col("doc_id").alias("_gone"), F.col("mark").alias("_mark")).distinct(), "gone")
    return docs.join(checked(gone), (docs[f"`{key}`"].cast("long") == gone["_gone"])
                     & (F.xxhash64(whole(text)) == gone["_mark"]), "left_anti")
