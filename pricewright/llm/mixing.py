"""Interleaving of sources at target weights by Pfair windows and earliest deadlines.

Each source is cut into blocks of documents in the order of their identifiers. With
a weight of ``units / period``, block ``j`` of a source (from 0) may not run before
slot ``floor(j * period / units)`` and must run before ``ceil((j + 1) * period / units)``.
One block runs per slot, of those released the one with the earliest deadline. As
the units add up to the period, every window is met, so that at any slot no source
is a whole block ahead or behind its weight while it has blocks left; after that
its slots stay empty. Windows repeat every period, so one period is scheduled, as an
array fold in which a slot costs a look at each source, and all blocks look up their
slot in it.

DataFrame functions only. The numbers within a source come from sorted ranges,
so a source with a third of all rows is no burden on one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.llm.common import BROADCAST_KEYS, checked, salted_left_join, salts_of_large_keys, without_keys
from pricewright.operators.ordering import numbered
from pricewright.session import staged

BLOCK_ROWS = 16
PERIOD = 1000


def square_root_weight(rows: Column) -> Column:
    """Between equal weights and natural ones: the root of the size, in thousandths."""
    return F.floor(F.sqrt(rows.cast("double")) * 1000).cast("long")


def _units(sizes: DataFrame, period: int) -> DataFrame:
    """Whole units per source that add up to ``period``, at least one each, the rest by largest remainder."""
    every = Window.partitionBy()
    spare = F.lit(period) - F.count(F.lit(1)).over(every)
    total = F.greatest(F.sum("weight").over(every), F.lit(1))
    shared = sizes.withColumn("given", F.expr("weight") * spare).withColumn("total", total).select(
        "*", F.expr("1 + given div total").alias("base"), F.expr("given % total").alias("remainder"))
    place = F.row_number().over(Window.orderBy(F.desc("remainder"), "label"))
    left = F.lit(period) - F.sum("base").over(every)
    return shared.withColumn("units", F.col("base") + (place <= left).cast("long")).drop(
        "given", "total", "base", "remainder")


def _one_period(units: DataFrame, period: int) -> DataFrame:
    """``label, job, slot``: the earliest-deadline schedule of one period."""
    listed = units.agg(F.sort_array(F.collect_list(F.struct("label", "units"))).alias("of"))
    size = F.size("of")

    def step(state: Column, slot: Column) -> Column:
        def window(source: Column, index: Column) -> Column:
            done = F.get(state["done"], index)
            released = F.floor(done * period / source["units"]) <= slot
            deadline = F.ceil((done + 1) * period / source["units"])
            return F.when((done < source["units"]) & released, F.struct(deadline.alias("by"), index.alias("at")))

        best = F.array_min(F.transform(F.col("of"), window))["at"]
        # bound by a list of one, so that it is found once a slot and not once a source
        return F.get(F.transform(F.array(best), lambda chosen: F.struct(
            F.transform(state["done"], lambda n, i: n + (i == chosen).cast("long")).alias("done"),
            F.concat(state["order"], F.array(chosen)).alias("order"))), F.lit(0))

    start = F.struct(
        F.transform(F.sequence(F.lit(1), size), lambda _: F.lit(0).cast("long")).alias("done"),
        F.expr("cast(array() as array<int>)").alias("order"))
    order = F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, step, lambda state: state["order"])
    slots = listed.select("of", F.posexplode(order).alias("slot", "at"))
    return slots.select(
        F.get("of", F.col("at"))["label"].alias("label"), F.col("slot").cast("long").alias("slot"),
        (F.row_number().over(Window.partitionBy("at").orderBy("slot")) - 1).cast("long").alias("job"))


def mixed(docs: DataFrame, weight: Column | None = None, block_rows: int = BLOCK_ROWS, period: int = PERIOD,
          key: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per row: ``doc_id, source, block, release, deadline, slot, place``.

    ``weight`` is a whole number made of ``source``, ``rows`` (of that source) and
    ``all_rows``; by default the root of ``rows``. ``place`` counts all rows in the
    mixed order, from 0, without the empty slots. A null source is a source of its
    own, null keys come first, rows that repeat a key are told apart by their order
    only, and an empty table gives an empty result. The period grows to ten slots
    per source if it is shorter.
    """
    label = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), label.alias("label"))
    ranked = staged(numbered(rows, ["label", "doc_id"], "n"), "mixing")
    sizes = ranked.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("first"))
    sizes = staged(sizes, "sources").withColumns({
        "all_rows": F.sum("rows").over(Window.partitionBy()),
        "source": F.when(F.col("label") != "", F.substring("label", 2, 1 << 30)),
    })
    period = max(period, 10 * sizes.count())
    weighted = sizes.withColumn("weight", weight if weight is not None else square_root_weight(F.col("rows")))
    units = staged(_units(weighted, period), "units")
    jobs = staged(_one_period(units, period), "period")
    table = staged(units.join(jobs, "label").select("label", "job", F.col("slot").alias("at"), "units", "source"), "jobs")
    own = units.select("label", "first", "units")
    if units.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        shared = ranked.join(F.broadcast(own), "label")
    else:
        shared = salted_left_join(ranked, own, "label", salts_of_large_keys(sizes, "label", "rows"), "n")
    blocks = (
        shared
        .withColumn("block", F.expr(f"(n - first) div {block_rows}"))
        .withColumn("round", F.expr(f"(block div units) * {period}"))
        .withColumn("job", F.expr("block % units"))
        .drop("units", "first")
        .join(checked(table), ["label", "job"])
        .select("doc_id", "source", "n", "block",
                (F.col("round") + F.floor(F.col("job") * period / F.col("units"))).alias("release"),
                (F.col("round") + F.ceil((F.col("job") + 1) * period / F.col("units"))).alias("deadline"),
                (F.col("round") + F.col("at")).alias("slot"))
    )
    return numbered(blocks, ["slot", "n"], "place").withColumn("place", F.col("place") - 1).drop("n")


def at_most_a_share(share: float) -> Column:
    """The size of a source as its weight, but at most ``share`` of all rows."""
    return F.least(F.col("rows"), F.floor(F.col("all_rows") * share)).cast("long")


def to_weights(docs: DataFrame, share: float, key: str = "doc_id", source: str = "source") -> DataFrame:
    """The documents, sources larger than ``share`` of all rows held to that weight.

    The mixture ends where the last of the other sources ends, or, where all are
    larger than ``share``, where the first of them runs out; blocks of a source above
    its weight whose slot lies behind that are left out. All documents of the other
    sources stay, and so do all where no source is above ``share`` or there is only one.
    """
    order = staged(mixed(docs, at_most_a_share(share), key=key, source=source), "mixed")
    sizes = order.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.max("slot").alias("ends"))
    total = F.sum("rows").over(Window.partitionBy())
    marked = sizes.withColumn("large", F.col("rows") > F.floor(total * share))
    ends = F.coalesce(F.max(F.when(~F.col("large"), F.col("ends"))), F.min("ends"))
    end = staged(marked.agg(ends.alias("end")), "horizon").first()["end"]
    if end is None:
        return docs
    surplus = order.join(F.broadcast(marked.filter("large").select("source")),
                         order["source"].eqNullSafe(marked["source"]), "left_semi").filter(F.col("slot") > end)
    return without_keys(docs, key, staged(surplus.select("doc_id"), "surplus"))
