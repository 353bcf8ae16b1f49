"""A manifest of a dataset: Merkle trees per group whose leaf places come from bitmap ranks.

The identifiers of a group are bits of a sparse bitmap: one 64-bit word for each 64
consecutive numbers, empty words left out. Words of all tasks are merged by a bitwise
or, with the rows they stand for. A directory says how many rows lie before each word,
so that a leaf's place is the directory's count and the set bits below its own:
no leaf is sorted. Identifiers that repeat (and a null one) have a row of counts
instead of a bit and are numbered among themselves.

Nodes then fall into slot arrays of 1,024 by their place. An array is filled by slot,
folded ten levels at once and becomes one node of the next round; from the last round
down, each array adds its own siblings to the proof of its node. The trees' roots are
the leaves of one more tree over the groups in order.

Digests are lower-case hexadecimal SHA-256; DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.llm.common import BROADCAST_KEYS, salted_left_join, salts_of_large_keys
from pricewright.operators.ordering import numbered, running_totals
from pricewright.session import staged

SLOT_BITS = 10
BROADCAST_BYTES = 8 << 20
_WORD_BITS, _CHUNK_BITS = 6, 6  # identifiers to a word, words to an entry of the directory
_PROOF = "array<struct<digest: string, before: boolean>>"


def framed(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; null is a hyphen."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[framed(value) for value in values]), 256)


def _with_group_numbers(leaves: DataFrame) -> DataFrame:
    """Leaves with ``group_no, rows`` instead of their label; labels are in order of their bytes."""
    sizes = staged(leaves.groupBy("label").agg(F.count(F.lit(1)).alias("rows")), "group-sizes")
    groups = staged(numbered(sizes, ["label"], "n").select("label", (F.col("n") - 1).alias("group_no"), "rows"), "groups")
    count, size = groups.agg(F.count(F.lit(1)), F.sum(F.octet_length("label"))).first()
    if count <= BROADCAST_KEYS and (size or 0) <= BROADCAST_BYTES:
        return leaves.join(F.broadcast(groups), "label").drop("label")
    return salted_left_join(leaves, groups, "label", salts_of_large_keys(sizes, "label", "rows"), "leaf").drop("label")


def _word() -> Column:
    """The number of an identifier's word; null lies before all others."""
    return F.coalesce(F.shiftright("doc_id", _WORD_BITS), F.lit(-(1 << 58)))


def _bit() -> Column:
    return F.coalesce(F.col("doc_id").bitwiseAND(F.lit((1 << _WORD_BITS) - 1)).cast("int"), F.lit(0))


def _ranked(rows: DataFrame, directory: DataFrame) -> DataFrame:
    """Rows of different identifiers with their ``place``."""
    below = F.expr("bit_count(bits & ~shiftleft(-1L, bit))")
    more = F.aggregate("extras", F.lit(0).cast("long"), lambda n, one: n + F.when(one["bit"] < F.col("bit"), one["n"]).otherwise(0))
    return rows.withColumns({"word": _word(), "bit": _bit()}).join(directory, ["group_no", "word"]).withColumn(
        "place", F.col("before") + below + F.coalesce(more, F.lit(0))).drop("word", "bit", "bits", "before", "extras")


def placed(leaves: DataFrame) -> DataFrame:
    """Rows of ``group_no, doc_id, leaf`` with ``place``: how many rows of their group come before.

    The order is by ``doc_id`` (null first), then ``leaf``.
    """
    one = F.when(F.col("doc_id").isNotNull(), F.expr("shiftleft(1L, bit)")).otherwise(F.lit(0).cast("long"))
    marked = leaves.select("group_no", "doc_id", _word().alias("word"), _bit().alias("bit"))
    words = staged(marked.groupBy("group_no", "word").agg(
        F.bit_or(one).alias("bits"), F.count(F.lit(1)).alias("rows")), "bitmaps")
    # words with more rows than bits hold identifiers that repeat
    crowded = words.filter("bit_count(bits) < rows").select("group_no", "word")
    repeats = staged(marked.join(crowded, ["group_no", "word"], "left_semi").groupBy("group_no", "word", "bit").agg(
        F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL"), "repeats")
    extras = repeats.groupBy("group_no", "word").agg(  # at most 64 of a word
        F.collect_list(F.struct("bit", (F.col("n") - 1).alias("n"))).alias("extras"))

    chunk = F.shiftright("word", _CHUNK_BITS)
    chunks = running_totals(words.groupBy("group_no", chunk.alias("chunk")).agg(F.sum("rows").alias("rows")),
                            ["group_no"], ["chunk"], {"upto": F.col("rows")})
    inside = F.sum("rows").over(Window.partitionBy("group_no", "chunk").orderBy("word").rowsBetween(
        Window.unboundedPreceding, -1))
    directory = staged(
        words.withColumn("chunk", chunk).withColumn("inside", F.coalesce(inside, F.lit(0)))
        .join(chunks.select("group_no", "chunk", (F.col("upto") - F.col("rows")).alias("earlier")), ["group_no", "chunk"])
        .join(extras, ["group_no", "word"], "left")
        .select("group_no", "word", "bits", (F.col("earlier") + F.col("inside")).alias("before"), "extras"), "directory")
    if repeats.limit(1).count() == 0:
        return _ranked(leaves, directory)

    # rows of a repeated identifier are numbered over sorted ranges, as it may have any share of all
    name = F.concat_ws(":", "group_no", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    firsts = staged(_ranked(repeats.select("group_no", "doc_id", "n"), directory).select(
        name.alias("name"), F.col("place").alias("at"), "n"), "firsts")
    salts = salts_of_large_keys(firsts, "name", "n")
    met = staged(salted_left_join(leaves.withColumn("name", name), firsts.drop("n"), "name", salts, "leaf").withColumn(
        "tie", F.monotonically_increasing_id()), "met")
    order = staged(numbered(met.filter("at IS NOT NULL"), ["name", "leaf", "tie"], "n"), "repeated")
    starts = order.groupBy("name").agg(F.min("n").alias("start"))
    several = salted_left_join(order, starts, "name", salts, "tie").withColumn("place", F.expr("at + n - start"))
    gone = ("name", "at", "tie")
    return _ranked(met.filter("at IS NULL").drop(*gone), directory).unionByName(several.drop(*gone, "n", "start"))


def _pairs(level: Column) -> Column:
    """The next level: digests of two nodes each, of the last alone if they are odd."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int")), lambda i: F.sha2(
        F.concat(F.get(level, i * 2), F.coalesce(F.get(level, i * 2 + 1), F.lit(""))), 256))


def _folded_arrays(nodes: DataFrame, turn: int) -> DataFrame:
    """``group_no, slab, rows, slots, levels, top``: slot arrays of nodes and all levels above them in this round."""
    depth = F.when(F.col("rows") > 1, F.length(F.bin(F.col("rows") - 1))).otherwise(0)
    steps = F.greatest(F.least(depth - SLOT_BITS * turn, F.lit(SLOT_BITS)), F.lit(0))
    arrays = nodes.groupBy("group_no", F.shiftright("place", SLOT_BITS).alias("slab")).agg(
        F.max("rows").alias("rows"), F.sort_array(F.collect_list(F.struct(
            F.col("place").bitwiseAND(F.lit((1 << SLOT_BITS) - 1)).cast("int").alias("slot"), "digest", "row"))).alias("slots"))
    levels = F.aggregate(
        F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.expr("cast(array() as array<int>)")),
        F.array(F.transform("slots", lambda slot: slot["digest"])),
        lambda done, _: F.concat(done, F.array(_pairs(F.element_at(done, -1)))))
    return arrays.withColumn("levels", levels).withColumn("top", F.get(F.element_at("levels", -1), F.lit(0)))


def _up(nodes: DataFrame) -> list[DataFrame]:
    """The slot arrays of each round; the last has one array, and so one root, per group."""
    rounds: list[DataFrame] = []
    while True:
        arrays = staged(_folded_arrays(nodes, len(rounds)), "slots")
        rounds.append(arrays)
        if not arrays.filter("slab > 0").limit(1).count():
            return rounds
        nodes = arrays.select("group_no", F.col("slab").alias("place"), "rows", F.col("top").alias("digest"),
                              F.lit(None).cast("int").alias("row"))


def _down(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``row, digest, place`` of all first nodes with the columns of ``tops`` and the whole ``proof`` up to its end.

    ``tops`` has ``group_no, proof`` and what else holds for a group.
    """
    upper, more = tops.withColumn("slab", F.lit(0).cast("long")), [n for n in tops.columns if n not in ("group_no", "proof")]
    for arrays in reversed(rounds):
        def own(slot: Column) -> Column:
            return F.transform(F.slice("levels", F.lit(1), F.size("levels") - 1), lambda level, i: F.struct(
                F.get(level, F.call_function("shiftright", slot, i).bitwiseXOR(F.lit(1))).alias("digest"),
                (F.call_function("shiftright", slot, i).bitwiseAND(F.lit(1)) == 1).alias("before")))

        nodes = F.transform("slots", lambda one: F.struct(
            (F.shiftleft("slab", SLOT_BITS) + one["slot"]).alias("slab"), one["row"].alias("row"),
            one["digest"].alias("digest"), F.concat(own(one["slot"]), F.col("proof")).cast(_PROOF).alias("proof")))
        met = arrays.select("group_no", "slab", "slots", "levels").join(upper, ["group_no", "slab"])
        upper = met.select("group_no", *more, nodes.alias("nodes")).select("group_no", *more, F.inline("nodes"))
    return upper.withColumnRenamed("slab", "place")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings, level by level, lead to."""
    def step(node: Column, other: Column) -> Column:
        sibling = F.coalesce(other["digest"], F.lit(""))
        return F.sha2(F.when(other["before"], F.concat(sibling, node)).otherwise(F.concat(node, sibling)), 256)

    return F.aggregate(proof, leaf, step)


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings in order; a node without one adds nothing."""
    return F.sha2(F.array_join(F.transform(proof, lambda other: other["digest"]), ""), 256)


def manifest(docs: DataFrame, leaf: Column, claim: Column | None = None, key: str = "doc_id", group: str = "lang") -> DataFrame:
    """``doc_id, leaf, claim, place, subroot, root, proof`` for every row.

    ``leaf`` is the row's digest and ``claim`` (by default the same) one that may be
    checked against the root by ``folded``. ``proof`` lists the siblings from leaf to
    root: their digest (null where a node is alone) and whether they come before it.
    Leaves of a group are in order of the key, null first; rows that repeat a key are
    in order of their leaf. A null group is a group of its own, before all others. An
    empty table gives an empty result.
    """
    label = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    leaves = staged(docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"), label.alias("label"), leaf.alias("leaf"),
        (leaf if claim is None else claim).alias("claim")), "leaves")
    nodes = placed(_with_group_numbers(leaves)).select(
        "group_no", "place", "rows", F.col("leaf").alias("digest"), F.struct("doc_id", "claim").alias("row"))
    rounds = _up(nodes)
    subroots = staged(rounds[-1].select("group_no", F.col("top").alias("subroot")), "subroots")
    whole = _up(subroots.select(F.lit(0).cast("long").alias("group_no"), F.col("group_no").alias("place"), F.lit(
        subroots.count()).cast("long").alias("rows"), F.col("subroot").alias("digest"), F.lit(None).cast("int").alias("row")))
    root = whole[-1].select("group_no", F.col("top").alias("root"), F.expr(f"cast(array() as {_PROOF})").alias("proof"))
    groups = staged(_down(whole, root).select(
        F.col("place").alias("group_no"), F.col("digest").alias("subroot"), "root", "proof"), "group-proofs")
    return _down(rounds, groups).select("row.doc_id", F.col("digest").alias("leaf"), "row.claim", "place", "subroot", "root", "proof")
