"""Manifest, periodic runs and vantage-point trees against brute force on small, awkward tables."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import SCHEMA, awkward, split, words

from pricewright.llm import merkle, periodic_runs, queries, vp_trees

MANY = "doc_id long, text string, lang string, source string, n_chars long, slots string, row string, word long, place int"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# manifest

def framed(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, more: int = 0) -> str:
    doc_id, text, lang, source, n_chars = row[:5]
    return h(*map(framed, (doc_id, source, lang, n_chars if n_chars is None else n_chars + more, text)))


def levels_of(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels: list[list[str]], at: int) -> list[tuple[str, bool]]:
    out = []
    for level in levels[:-1]:
        out.append((level[at ^ 1] if at ^ 1 < len(level) else "", at % 2 == 1))
        at //= 2
    return out


def manifest_by_force(rows) -> list[tuple]:
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(((row[0] is not None, row[0] or 0), leaf_of(row), row))
    names = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {lang: levels_of([leaf for _, leaf, _ in sorted(groups[lang], key=lambda one: one[:2])]) for lang in names}
    top = levels_of([trees[lang][-1][0] for lang in names])
    out = []
    for number, lang in enumerate(names):
        for at, (_, leaf, row) in enumerate(sorted(groups[lang], key=lambda one: one[:2])):
            proof = path(trees[lang], at) + path(top, number)
            altered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf_of(row, 1) if altered else leaf
            for sibling, before in proof:
                node = h(sibling, node) if before else h(node, sibling)
            out.append((row[0], leaf, trees[lang][-1][0], top[-1][0], h(*[s for s, _ in proof]), node, node == top[-1][0]))
    return out


def manifest_rows() -> list[tuple]:
    random, rows = np.random.default_rng(3), []
    for i in range(1300):
        doc_id = [i, -i, 2 ** 62 + 3 * i, None, 64 * i + 63][i % 5 if i % 10 else 0]
        lang = [None, "en", "é", "z", f"own{i}"][min(i % 31, 4) if i % 200 else 4]
        rows.append((doc_id, [None, "", f"text {i % 7}"][i % 3], lang, [None, "s"][i % 2], [None, i, 2 ** 63 - 1][i % 3],
                     "s", "r", 1, 2))
    rows += [(77, "same", "z", "s", 4, "s", "r", 1, 2)] * 40
    return [rows[i] for i in random.permutation(len(rows))]


def test_manifest(spark):
    rows = manifest_rows()
    got = queries.verified_manifest(spark.createDataFrame(rows, MANY).repartition(3)).collect()
    assert got[0].asDict().keys() == {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"}
    assert Counter(map(tuple, got)) == Counter(manifest_by_force(rows))


def test_arrays_of_few_slots_and_a_single_leaf(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SLOT_BITS", 2)
    rows = [(i, "t", "l", "s", i, "s", "r", 1, 2) for i in range(37)]
    got = queries.verified_manifest(spark.createDataFrame(rows, MANY)).collect()
    assert Counter(map(tuple, got)) == Counter(manifest_by_force(rows))
    one = queries.verified_manifest(spark.createDataFrame(rows[:1], MANY)).collect()
    assert [tuple(r) for r in one] == manifest_by_force(rows[:1])
    assert one[0].leaf == one[0].subroot == one[0].root and one[0].proof_sha256 == h("")


def test_an_empty_manifest(spark):
    assert queries.verified_manifest(spark.createDataFrame([], MANY)).count() == 0


# periodic runs

def runs_by_force(own: list, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    found = set()
    for q in range(1, len(own) // times + 1):
        at = q
        while at < len(own):
            end = at
            while end < len(own) and own[end] == own[end - q]:
                end += 1
            if end > at and end - at + q >= max(least, times * q):
                found.add((at - q, end - at + q, q))
            at = max(end, at + 1)
    return sorted(run for run in found if not any(run[:2] == other[:2] and other[2] < run[2] for other in found))


def test_runs_are_those_of_brute_force():
    random = np.random.default_rng(8)
    for _ in range(400):
        least, texts = int(random.choice([1, 3, 8, 24])), []
        for _ in range(random.integers(1, 4)):
            own = []
            for _ in range(random.integers(0, 5)):
                own += random.integers(0, random.choice([2, 3, 8]), random.integers(1, 30)).tolist() * int(random.integers(1, 7))
                own = own[:len(own) - int(random.integers(0, 3))]
            texts.append(own)
        _, names = np.unique(np.array([1000 * i + w for i, own in enumerate(texts) for w in own], dtype=np.int64),
                             return_inverse=True)
        got = periodic_runs.find_runs(names.astype(np.int64), np.cumsum([0, *map(len, texts)]), least).tolist()
        assert got == [[i, *run] for i, own in enumerate(texts) for run in runs_by_force(own, least)]


def test_one_word_many_times_is_one_run_at_once():
    assert periodic_runs.find_runs(np.zeros(300_000, dtype=np.int64), np.array([0, 300_000])).tolist() == [[0, 0, 300_000, 1]]


def run_row(doc_id, text) -> tuple:
    own, code = split(text), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if code % 10 == 0 and own:
        a = code // 10 % len(own)
        p = 1 + (len(own) - a) // (3 + code // 10 % 8)
        own = [w if i < a else own[a + (i - a) % p] for i, w in enumerate(own)]
    runs, gone = runs_by_force(own), set()
    for start, length, period in runs:
        gone |= set(range(start + period, start + length))
    best = min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=(None, None, None))
    said = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, h(said),
            h(" ".join(w for i, w in enumerate(own) if i not in gone)))


def run_rows() -> list[tuple]:
    rows = awkward()
    texts = [words(40, 60), "a b " * 40 + "c " * 30 + "end", words(41, 9) + " " + " ".join([words(42, 7)] * 6), "x " * 23, "y\n" * 24]
    rows += [(1000 + i, text, "en", "s", "x", 1, 2) for i, text in enumerate(texts * 8)]
    return [*rows, *rows[5:9], (None, "z " * 50, "en", "s", "x", 1, 2)]


def test_run_digests(spark):
    rows = run_rows()
    got = queries.run_digests(queries.with_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3))).collect()
    assert Counter(map(tuple, got)) == Counter(run_row(i, text) for i, text, *_ in rows)
    assert periodic_runs.collapsed(spark.createDataFrame([], SCHEMA)).count() == 0


# vectors

VECTORS = "vec_id long, embedding array<double>, label int, query long, cell string, vector string, score double"


def vector_rows() -> list[tuple]:
    random = np.random.default_rng(2)
    centres, rows = random.normal(size=(8, 12)) * 3, []
    for i in range(700):
        rows.append((i, ((centres[i % 8] + random.normal(size=12) * 0.3) * (10 if i % 50 == 0 else 1)).round(3).tolist()))
    rows += [(2000 + i, [1.0] + [0.0] * 11) for i in range(150)]
    rows += [(3000 + i, random.normal(size=3).tolist()) for i in range(15)]
    rows += [(None, [1.0] * 12), (4000, None), (4020, []), (4040, [0.0] * 12), (4060, [None] + [1.0] * 11),
             (4080, [float("nan")] * 12), (4100, [float("inf")] * 12), (4120, [5.0])]
    return [(*row, 1, 2, "c", "v", 0.5) for row in rows]


def nearest_by_force(rows, k: int) -> dict[int, list]:
    good = [(row[0], np.array(row[1])) for row in rows if row[0] is not None and row[1]
            and all(x is not None and np.isfinite(x) for x in row[1]) and any(row[1])]
    out = {}
    for query, vector in good:
        if query % 20 == 0:
            found = sorted((-float((vector * v).sum()), i) for i, v in good if i != query and len(v) == len(vector))[:k]
            out[query] = [(i, -score) for score, i in found]
    return out


@pytest.mark.parametrize("factor, least", [(1.0, 1.0), (vp_trees.FACTOR, 0.99)])
def test_nearest_vectors(spark, monkeypatch, factor, least):
    for name, value in (("SHARD_ROWS", 200), ("LEAF", 32), ("CELL_SAMPLE", 40), ("SAMPLE_ROWS", 500), ("QUERY_BLOCK", 20)):
        monkeypatch.setattr(vp_trees, name, value)
    rows = vector_rows()
    want, got = nearest_by_force(rows, 20), defaultdict(list)
    found = vp_trees.nearest(spark.createDataFrame(rows, VECTORS).repartition(4), F.col("vec_id") % 20 == 0, 20, factor)
    for row in found.orderBy("query_id", "rank").collect():
        got[row.query_id].append((row.rank, row.vec_id, row.score))
    assert got.keys() == {query for query, near in want.items() if near}
    if factor == 1:
        for query, near in want.items():
            assert [one[:2] for one in got[query]] == [(i + 1, vec_id) for i, (vec_id, _) in enumerate(near)]
            assert np.allclose([one[2] for one in got[query]], [score for _, score in near], rtol=1e-14, atol=0)
    hits = sum(len({i for _, i, _ in got[query]} & {i for i, _ in near}) for query, near in want.items())
    assert hits >= least * sum(map(len, want.values()))


def test_a_tree_leaves_branches_out():
    random = np.random.default_rng(5)
    centres = random.normal(size=(16, 8)) * 4
    points = np.repeat(centres, 100, axis=0) + random.normal(size=(1600, 8)) * 0.05
    queries_ = points[::100]
    none = np.full(16, -np.inf)
    exact = vp_trees.Search(np.arange(1600), points, queries_, none, 5, 1.0, leaf=32)
    loose = vp_trees.Search(np.arange(1600), points, queries_, none, 5, 4.0, leaf=32)
    best = np.sort(queries_ @ points.T, axis=1)[:, :-6:-1]
    order = np.lexsort((-exact.score, exact.of))
    assert np.allclose(exact.score[order].reshape(16, 5), best)
    assert loose.looked_at <= exact.looked_at < 16 * 1600


def test_no_vectors_and_a_factor_below_one(spark):
    none = spark.createDataFrame([], VECTORS)
    assert vp_trees.nearest(none, F.col("vec_id") % 20 == 0).count() == 0
    with pytest.raises(ValueError):
        vp_trees.nearest(none, F.lit(True), factor=0.5)
