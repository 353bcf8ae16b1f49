"""Nearest vectors by inner product with vantage-point trees per shard.

Lengthened by one coordinate to a common norm, vectors of one shard lie on a sphere,
and so does a query scaled to it: the largest inner product is then the smallest
distance. A tree splits its vectors at the median distance to a vantage point. A
branch is left out where ``factor`` times the least distance that the triangle
inequality allows exceeds the distance of the worst neighbour held so far: with a
factor of one the search is exact, above it the bound is relaxed.

Shards come from the same kind of tree over a bounded sample: one per dimension and
doubling of the norm, each leaf a cell, large cells dealt out over several shards. A
query first searches the cell it would lie in, then, with the score found, only those
cells that the bound does not exclude. Vectors of a kind the sample lacks are in one
cell per dimension, which every query of it visits. Equal vectors are one class from
the start, so copies cost one search and ties go to the smallest identifiers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm.common import salted_left_join, salts_of_large_keys
from pricewright.operators.ordering import first_per_group
from pricewright.session import staged

NEAREST, FACTOR = 20, 1.1
SAMPLE_ROWS, SAMPLE_BYTES = 2048, 32 << 20  # vectors that shape the cells
CELL_SAMPLE = 64  # sampled vectors of a cell at least
SHARD_ROWS, SHARD_BYTES = 8192, 16 << 20
QUERY_BLOCK = 4096
LEAF = 256
_SLACK = 1e-6  # of the norm, for rounding of distances


class Tree:
    """A vantage-point tree over the rows of ``points``, which all have norm ``radius``."""

    def __init__(self, points: np.ndarray, radius: float, leaf: int, seed: int = 0):
        self.points, self.radius = points, radius
        self.nodes: list[tuple] = []  # ("leaf", rows) or (vantage, farthest inside, nearest outside, inside, outside)
        self._random = np.random.default_rng(seed)
        self._grow(np.arange(len(points)), leaf)

    def distances(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2.0 * self.radius ** 2 - 2.0 * (one @ two.T), 0.0))

    def _grow(self, rows: np.ndarray, leaf: int) -> int:
        number = len(self.nodes)
        self.nodes.append(("leaf", rows))
        if len(rows) > leaf:
            vantage = int(rows[self._random.integers(len(rows))])
            away = self.distances(self.points[rows], self.points[vantage])
            half = len(rows) // 2
            order = np.argpartition(away, half - 1)
            inside, outside = order[:half], order[half:]
            farthest, nearest = float(away[inside].max()), float(away[outside].min())
            self.nodes[number] = (vantage, farthest, nearest, self._grow(rows[inside], leaf), self._grow(rows[outside], leaf))
        return number

    def cells(self) -> list[int]:
        return [number for number, node in enumerate(self.nodes) if node[0] == "leaf"]

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf each point belongs to: a border halfway between the sampled sides."""
        at = np.zeros(len(points), dtype=np.int64)
        for number, node in enumerate(self.nodes):  # a parent comes before its children
            here = np.flatnonzero(at == number)
            if node[0] != "leaf" and len(here):
                away = self.distances(points[here], self.points[node[0]])
                at[here] = np.where(away <= (node[1] + node[2]) / 2, node[3], node[4])
        return at

    def least_distances(self, points: np.ndarray) -> np.ndarray:
        """For each point and leaf how near a point of that leaf can be at least."""
        bounds = {0: np.zeros(len(points))}
        for number, node in enumerate(self.nodes):
            if node[0] != "leaf":
                away, border = self.distances(points, self.points[node[0]]), (node[1] + node[2]) / 2
                bounds[node[3]] = np.maximum(bounds[number], away - border)
                bounds[node[4]] = np.maximum(bounds[number], border - away)
        return np.stack([bounds[number] for number in self.cells()], axis=1)


def on_sphere(vectors: np.ndarray, radius: float) -> np.ndarray:
    """Vectors of a norm up to ``radius``, lengthened by one coordinate to have it."""
    rest = np.sqrt(np.maximum(radius ** 2 - (vectors * vectors).sum(axis=1), 0.0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def scaled_queries(queries: np.ndarray, radius: float) -> np.ndarray:
    """Queries on the same sphere; their neighbours stay the same."""
    norms = np.sqrt((queries * queries).sum(axis=1))
    return np.concatenate([queries * (radius / norms)[:, None], np.zeros((len(queries), 1))], axis=1)


class Search:
    """The ``most`` best rows of a shard for each query, best first, ties to the smaller identifier."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray, floors: np.ndarray, most: int,
                 factor: float, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.queries = ids[order], vectors[order], queries
        self.most, self.factor = most, factor
        self.norms = np.sqrt((queries * queries).sum(axis=1))
        self.radius = float(np.sqrt((vectors * vectors).sum(axis=1)).max())
        self.tree = Tree(on_sphere(self.vectors, self.radius), self.radius, leaf)
        self.asked = scaled_queries(queries, self.radius)
        self.worst = floors.copy()
        self.of, self.row, self.score = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        self.looked_at = 0
        self._visit(0, np.arange(len(queries)))

    def _reach(self, queries: np.ndarray) -> np.ndarray:
        """The distance of the worst neighbour held, so far as there are enough."""
        worst, r = self.worst[queries], self.radius
        with np.errstate(invalid="ignore"):
            return np.where(np.isfinite(worst), np.sqrt(np.maximum(2 * r * r - 2 * r * worst / self.norms[queries], 0.0)),
                            np.inf)

    def _visit(self, number: int, queries: np.ndarray) -> None:
        if not len(queries):
            return
        node = self.tree.nodes[number]
        if node[0] == "leaf":
            self._look_at(node[1], queries)
            return
        vantage, farthest, nearest, inside, outside = node
        away = self.tree.distances(self.asked[queries], self.tree.points[vantage])
        first_in = away <= (farthest + nearest) / 2
        self._visit(inside, queries[first_in])
        self._visit(outside, queries[~first_in])
        reach = self._reach(queries) + _SLACK * self.radius
        self._visit(outside, queries[first_in & (self.factor * (nearest - away) <= reach)])
        self._visit(inside, queries[~first_in & (self.factor * (away - farthest) <= reach)])

    def _look_at(self, rows: np.ndarray, queries: np.ndarray) -> None:
        self.looked_at += len(rows) * len(queries)
        near = self.queries[queries] @ self.vectors[rows].T
        enough = self.worst[queries] - 1e-9 * self.radius * self.norms[queries]
        at, candidate = np.nonzero(near >= enough[:, None])
        if not len(at):
            return
        of, row = queries[at], rows[candidate]
        # the same sum for a pair wherever it is met
        score = (self.queries[of] * self.vectors[row]).sum(axis=1)
        mine = np.isin(self.of, np.unique(of))
        of, row, score = (np.concatenate([held[mine], new]) for held, new in (
            (self.of, of), (self.row, row), (self.score, score)))
        order = np.lexsort((row, -score, of))  # rows are in order of their identifiers
        of, row, score = of[order], row[order], score[order]
        begins = np.flatnonzero(np.diff(of, prepend=-1))
        place = np.arange(len(of)) - np.repeat(begins, np.diff(np.append(begins, len(of))))
        stay = place < self.most
        last = place == self.most - 1
        self.worst[of[last]] = np.maximum(self.worst[of[last]], score[last])
        self.of, self.row, self.score = (np.concatenate([held[~mine], new[stay]]) for held, new in (
            (self.of, of), (self.row, row), (self.score, score)))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


_FOUND = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search_shard(most: int, factor: float):
    def apply(shard: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(shard) or not len(asked):
            return _FOUND.empty_table()
        keys = asked["query"].to_numpy()
        found = Search(shard["vec_id"].to_numpy(), _matrix(shard["vector"]), _matrix(asked["vector"]),
                       asked["floor"].to_numpy().copy(), most, factor)
        return pa.Table.from_arrays([pa.array(keys[found.of]), pa.array(found.ids[found.row]), pa.array(found.score)],
                                    schema=_FOUND)

    return apply


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id, vector, dim, tier``: rows with an identifier and a vector of finite numbers that are not all zero."""
    numbers = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), numbers.alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)  # null, NaN or infinite if a number is
    rows = rows.withColumns({"dim": F.size("vector"), "square": square}).filter(
        "vec_id IS NOT NULL AND square > 0 AND square < cast('Infinity' AS double)")
    return rows.withColumn("tier", F.floor(F.log2(F.sqrt("square"))).cast("int")).drop("square")


def _trees(rows: DataFrame) -> dict[int, dict[int, Tree]]:
    """By dimension and tier a tree whose leaves are cells, from a bounded sample."""
    longest = rows.agg(F.max("dim")).first()[0] or 1
    count = int(max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * longest))))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(count).toPandas()
    out: dict[int, dict[int, Tree]] = {}
    for (dim, tier), part in sample.groupby(["dim", "tier"]):
        radius = 2.0 ** (int(tier) + 1)
        out.setdefault(int(dim), {})[int(tier)] = Tree(on_sphere(np.stack(part["vector"]), radius), radius, 2 * CELL_SAMPLE)
    return out


def _by_family(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[tuple[int, ...], np.ndarray]]:
    keys = np.stack([batch.column(name).to_numpy() for name in names], axis=1)
    for key in np.unique(keys, axis=0):
        yield tuple(int(part) for part in key), np.flatnonzero((keys == key).all(axis=1))


def _cells(trees: dict[int, dict[int, Tree]]):
    """The cell of each vector."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.empty(len(batch), dtype=object)
            for (dim, tier), rows in _by_family(batch, ["dim", "tier"]) if len(batch) else ():
                tree = trees.get(dim, {}).get(tier)
                if tree is None:
                    cells[rows] = f"{dim}:rest"
                else:
                    points = on_sphere(_matrix(batch.column("vector").take(pa.array(rows))), tree.radius)
                    cells[rows] = [f"{dim}:{tier}:{leaf}" for leaf in tree.cell_of(points)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array(cells, pa.string())],
                                             names=["vec_id", "vector", "cell"])

    return apply


def _visits(trees: dict[int, dict[int, Tree]], home: bool, factor: float):
    """The cells a query visits: its home, or all others that its floor does not exclude."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists: list[list[str]] = [[] for _ in range(len(batch))]
            floors = batch.column("floor").to_numpy(zero_copy_only=False)
            for (dim,), rows in _by_family(batch, ["dim"]) if len(batch) else ():
                of_dim = trees.get(dim)
                first = max(of_dim, key=lambda tier: (len(of_dim[tier].points), tier)) if of_dim else None
                vectors = _matrix(batch.column("vector").take(pa.array(rows)))
                norms = np.sqrt((vectors * vectors).sum(axis=1))
                for tier, tree in (of_dim or {}).items():
                    asked, cells = scaled_queries(vectors, tree.radius), tree.cells()
                    own = tree.cell_of(asked) if tier == first else np.full(len(rows), -1)
                    if home:
                        for at, leaf in zip(rows, own, strict=True):
                            lists[at] += [f"{dim}:{tier}:{leaf}"] if leaf >= 0 else []
                        continue
                    r = tree.radius
                    reach = np.sqrt(np.maximum(2 * r * r - 2 * r * floors[rows] / norms, 0.0)) + _SLACK * r
                    go = factor * tree.least_distances(asked) <= reach[:, None]
                    go &= np.array(cells)[None, :] != own[:, None]
                    for at, column in zip(*np.nonzero(go), strict=True):
                        lists[rows[at]].append(f"{dim}:{tier}:{cells[column]}")
                if home != bool(of_dim):
                    for at in rows:
                        lists[at].append(f"{dim}:rest")
            yield pa.RecordBatch.from_arrays([
                batch.column("query"), batch.column("vector"), batch.column("floor"),
                pa.array(lists, pa.list_(pa.string()))], names=["query", "vector", "floor", "cells"])

    return apply


def _searched(shards: DataFrame, sizes: DataFrame, asked: DataFrame, most: int, factor: float) -> DataFrame:
    """``query, vec_id, score``: the best of each shard for the queries that visit its cell."""
    visits = asked.withColumn("cell", F.explode("cells")).drop("cells", "dim")
    blocks = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks"))
    per_cell = staged(sizes.join(blocks, "cell"), "visited")
    left = shards.join(per_cell, "cell").select(
        "cell", "salt", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "vec_id", "vector")
    right = visits.join(per_cell, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        F.pmod(F.xxhash64("query"), "blocks").cast("int").alias("block"), "query", "vector", "floor")
    by = ["cell", "salt", "block"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(
        _search_shard(most, factor), "query long, vec_id long, score double")


def nearest(vectors: DataFrame, queries: Column, k: int = NEAREST, factor: float = FACTOR,
            key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products with each query, best first.

    Queries are the rows for which ``queries`` (of ``vec_id``) holds; all other rows of the
    same dimension are candidates, and ties go to the smaller identifier. Rows without
    an identifier, and vectors that are null, empty, zero or hold a null or a number
    that is not finite (or whose square is not), take no part. Of rows that repeat an
    identifier each vector is a candidate, but none of its own identifier; as a query,
    the one of the class with the smallest identifier speaks for it. Fewer than ``k`` candidates give fewer rows;
    an empty table gives an empty result.
    """
    if factor < 1:
        raise ValueError("a factor below one would prune more than it saves")
    rows = staged(usable(vectors, key, vector), "vectors")
    classes = staged(rows.groupBy("vector", "dim", "tier").agg(F.min("vec_id").alias("vec_id"), F.count(
        F.lit(1)).alias("n")), "classes")
    several = classes.filter("n > 1").select("vector", F.col("vec_id").alias("class"), "n")
    salts = salts_of_large_keys(several, "vector", "n")
    if several.limit(1).count():
        joined = salted_left_join(rows.select("vec_id", "vector"), several.drop("n"), "vector", salts, "vec_id")
    else:
        joined = rows.withColumn("class", F.lit(None).cast("long"))
    members = staged(joined.select("vec_id", F.coalesce("class", "vec_id").alias("class"),
                                   F.col("class").isNotNull().alias("copied")), "members")
    asking = staged(members.filter(queries).groupBy("vec_id").agg(F.min("class").alias("class")), "asking")

    trees = _trees(classes)
    placed = staged(classes.select("vec_id", "vector", "dim", "tier").mapInArrow(
        _cells(trees), "vec_id long, vector array<double>, cell string"), "placed")
    width = F.greatest(F.max(F.size("vector")), F.lit(1))
    of_shard = F.greatest(F.least(F.lit(SHARD_ROWS), F.floor(F.lit(SHARD_BYTES) / (8 * width))), F.lit(1))
    sizes = staged(placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / of_shard).cast("int").alias("salts")), "cells")
    shards = staged(placed.join(sizes, "cell").withColumn(
        "salt", F.pmod(F.xxhash64("vec_id"), "salts").cast("int")).drop("salts"), "shards")

    most = k + 1  # a query's own class is among them
    speakers = classes.join(asking.select(F.col("class").alias("vec_id")).distinct(), "vec_id", "left_semi").select(
        F.col("vec_id").alias("query"), "vector", "dim")
    schema = "query long, vector array<double>, floor double, cells array<string>"
    start = speakers.withColumn("floor", F.lit(float("-inf")))
    at_home = staged(_searched(shards, sizes, start.mapInArrow(_visits(trees, True, factor), schema), most, factor), "home")
    held = first_per_group(at_home, ["query"], [F.desc("score"), "vec_id"], most)
    floors = held.filter(F.col("place") == most).select("query", F.col("score").alias("floor"))
    further = staged(speakers.join(floors, "query", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))),
                     "further")
    elsewhere = _searched(shards, sizes, further.mapInArrow(_visits(trees, False, factor), schema), most, factor)
    best = staged(first_per_group(at_home.union(staged(elsewhere, "elsewhere")), ["query"], [F.desc("score"), "vec_id"],
                                  most).drop("place"), "best")

    copies = first_per_group(members.filter("copied").drop("copied"), ["class"], ["vec_id"], most).filter(
        "class <> vec_id").select(F.col("class").alias("vec_id"), F.col("vec_id").alias("copy"))
    few = copies.groupBy("vec_id").agg(F.collect_list("copy").alias("copies"))  # at most k of a class
    popular = salts_of_large_keys(best.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")), "vec_id", "n")
    more = salted_left_join(best, few, "vec_id", popular, "query").select("query", F.explode("copies").alias("vec_id"), "score")
    whole = best.unionByName(more)
    lists = first_per_group(whole, ["query"], [F.desc("score"), "vec_id"], most).groupBy(F.col("query").alias("class")).agg(
        F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    crowds = asking.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    answers = salted_left_join(asking, lists, "class", salts_of_large_keys(crowds, "class", "n"), "vec_id")
    own = F.slice(F.filter("found", lambda one: one["vec_id"] != F.col("vec_id")), 1, k)
    ranked = F.transform(own, lambda one, i: F.struct(
        (i + 1).alias("rank"), one["vec_id"].alias("vec_id"), one["score"].alias("score")))
    return answers.select(F.col("vec_id").alias("query_id"), ranked.alias("ranked")).select(
        "query_id", F.inline("ranked"))
