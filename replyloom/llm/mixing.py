"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies in the mix: the rates nearest to
one in relative entropy whose words add up to each source's target, none above ``cap``. Such
rates are exponentially tilted, ``min(cap, exp(tilt * size))`` with one tilt per source, and the
tilts minimise a convex dual. Newton's method finds them: each iteration is one aggregation
over the counts of (source, size), which hold all that matters about the documents, followed
by a step per source that a bracket keeps safe.

Rates then become whole copies. The copies of all documents of one source and size are rounded
along the running sum over sizes, longest first, and what this leaves of the target is mended
from the longest size that still fits to the shortest. Within a size the copies go to documents
by the hash of their key, with the rank taken in salted cells, so that a size that a third of
all documents share is no single task's work.

Only DataFrame functions are used, and only one number per iteration comes to the driver. What
is written between steps is small and goes to few files: an executor that writes to a local
folder runs a command for each of them, which for a moment counts with all memory of the executor.

Defined results: a null or blank text has size 0 and takes nothing; the null source comes last
in the cycle of weights; repeated rows are documents of their own; an empty table gives no
rows; sources of no words have target 0. Reruns agree, as nothing depends on partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyloom.llm.common import word_count
from replyloom.session import materialize

CELLS = 256
MAX_ROUNDS = 60
TOLERANCE = 1e-9
#: Files of a frame with one row per source.
STATE_FILES = 4


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """``(source, source_size, target)``: one row per source, from ``(source, size, n)``.

    Sources in code-point order, null last, take the weights in a cycle and share ``share``
    times all words; no target exceeds ``cap`` times its source, and what that leaves over is
    shared by weight again. The final targets are ``min(cap * size, weight * level)``: sources
    ordered by the level at which they are full, the level follows from running sums.
    """
    sources = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.element_at(F.array(*map(F.lit, weights)), F.col("place") % len(weights) + 1)
    ranked = sources.withColumn("place", (F.row_number().over(order) - 1).cast("int")).select(
        "source", "source_size", cycle.cast("double").alias("weight")
    )
    full = F.col("source_size") * float(cap)
    by_level = Window.orderBy("full_at", "source").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("full_at", "source").rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = (
        ranked.withColumn("full", full)
        .withColumn("full_at", F.col("full") / F.col("weight"))
        .withColumn("words", F.sum("source_size").over(everything) * float(share))
        .withColumn("before", F.coalesce(F.sum("full").over(by_level), F.lit(0.0)))
        .withColumn("weights", F.sum("weight").over(onward))
        # The level if all sources before this one are full and no other is: it rises up to the
        # first source that stays open and falls from there.
        .withColumn("if_open", (F.col("words") - F.col("before")) / F.col("weights"))
        .withColumn("level", F.max("if_open").over(everything))
    )
    target = F.least("full", F.coalesce(F.col("weight") * F.col("level"), F.col("full")))
    return levels.select("source", "source_size", target.alias("target"))


def tilts(sizes: DataFrame, goals: DataFrame, cap: float) -> DataFrame:
    """``(source, tilt)``: the solution of the dual for every source, by Newton iterations."""
    unit = F.col("target") / F.col("source_size")
    # At the ends of the bracket even the shortest text, of one word, has the mean rate or the cap.
    state = goals.where("source_size > 0").select(
        "source",
        "target",
        F.least(F.lit(0.0), F.log(unit)).alias("low"),
        F.log(F.lit(float(cap))).alias("high"),
        F.lit(0.0).alias("tilt"),
        (unit >= cap * (1 - 1e-12)).alias("full"),
    )
    state = materialize(
        state.withColumn("tilt", F.when(F.col("full"), F.col("high")).otherwise(F.col("tilt"))).coalesce(STATE_FILES), "tilts"
    )
    for _ in range(MAX_ROUNDS):
        rate = F.exp(F.col("tilt") * F.col("size"))
        words = F.col("n") * F.col("size")
        joined = sizes.where("size > 0").join(state.select(F.col("source").alias("of"), "tilt"), F.expr("source <=> of"))
        sums = joined.groupBy("source").agg(
            F.sum(words * F.least(rate, F.lit(float(cap)))).alias("value"),
            F.sum(F.when(rate < cap, words * F.col("size") * rate).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("value") - F.col("target")
        near = state.join(sums.withColumnRenamed("source", "of"), F.expr("source <=> of")).withColumns(
            {
                "low": F.when(gap < 0, F.col("tilt")).otherwise(F.col("low")),
                "high": F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high")),
                "newton": F.when(F.col("slope") > 0, F.col("tilt") - gap / F.col("slope")),
                "error": F.when(F.col("full"), 0.0).otherwise(F.abs(gap) / F.col("target")),
            }
        )
        inside = (F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high"))
        step = F.when(F.col("full") | (F.col("error") < TOLERANCE), F.col("tilt")).otherwise(
            F.when(inside, F.col("newton")).otherwise((F.col("low") + F.col("high")) / 2)
        )
        state = near.select("source", "target", "low", "high", step.alias("tilt"), "full", "error")
        state = materialize(state.coalesce(STATE_FILES), "tilts")
        worst = state.agg(F.max("error")).first()[0]
        if worst is None or worst < TOLERANCE:
            break
    return state.select("source", "tilt")


def quotas(sizes: DataFrame, goals: DataFrame, slopes: DataFrame, cap: int) -> DataFrame:
    """``(source, size, n, copies)``: whole copies of all documents of a source and size."""
    known = goals.select(F.col("source").alias("s1"), "target").join(
        slopes.select(F.col("source").alias("s2"), "tilt"), F.expr("s1 <=> s2")
    )
    rated = (
        sizes.where("size > 0")
        .join(known, F.expr("source <=> s1"))
        .withColumn("rate", F.least(F.exp(F.col("tilt") * F.col("size")), F.lit(float(cap))))
    )
    running = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.floor(F.sum(F.col("n") * F.col("rate")).over(running) + 0.5)
    rounded = (
        rated.withColumn("upto", upto)
        .withColumn(
            "copies",
            F.col("upto")
            - F.coalesce(F.lag("upto").over(Window.partitionBy("source").orderBy(F.desc("size"))), F.lit(0)),
        )
        .withColumn("copies", F.greatest(F.lit(0), F.least(F.col("copies"), F.col("n") * cap)))
    )
    # One entry per distinct size of a source: as many as its longest text has words at most.
    changes = F.aggregate(
        F.sort_array(F.collect_list(F.struct("size", "n", "copies")), asc=False),
        F.struct(
            F.round(F.first("target") - F.sum(F.col("size") * F.col("copies"))).cast("long").alias("left"),
            F.expr("cast(array() as array<struct<size: bigint, change: bigint>>)").alias("done"),
        ),
        lambda state, x: _mend(state, x, cap),
        lambda state: state["done"],
    )
    mended = rounded.groupBy("source").agg(changes.alias("done"))
    steps = mended.select(F.col("source").alias("s3"), F.inline("done")).withColumnRenamed("size", "size3")
    return rounded.join(steps, F.expr("source <=> s3 and size = size3"), "left").select(
        "source", "size", "n", "target", (F.col("copies") + F.coalesce("change", F.lit(0))).alias("copies")
    )


def _mend(state: Column, x: Column, cap: int) -> Column:
    """Give or take as many copies of one size as fit into the words that are left."""
    wanted = F.call_function("div", state["left"], x["size"])  # towards zero
    change = F.greatest(-x["copies"], F.least(wanted, x["n"] * cap - x["copies"]))
    return F.struct(
        (state["left"] - change * x["size"]).alias("left"),
        F.when(change == 0, state["done"])
        .otherwise(F.concat(state["done"], F.array(F.struct(x["size"].alias("size"), change.alias("change")))))
        .alias("done"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: int = 2,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``key``, ``size``, ``source``, ``source_size``, ``target``, ``copies`` and ``taken`` (words
    in the mix) of every row of ``docs``."""
    sized = materialize(
        docs.select(
            F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")
        ).withColumns(
            {"h": F.xxhash64(F.col("key").cast("string")), "cell": F.pmod(F.xxhash64("key", "size"), F.lit(CELLS))}
        ),
        "sizes",
    )
    cells = sized.groupBy("source", "size", "cell").agg(F.count("*").alias("in_cell"))
    # A source has as many rows as its texts have different sizes; in order, so that sums agree.
    sizes = sized.groupBy("source", "size").agg(F.count("*").alias("n")).repartition("source").sortWithinPartitions("source", "size")
    sizes = materialize(sizes, "counts")
    goals = materialize(targets(sizes, weights, share, cap), "targets")
    copies = quotas(sizes, goals, tilts(sizes, goals, cap), cap)

    # Every document of a size takes the whole part; the rest goes by rank, cell after cell.
    before = Window.partitionBy("source", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("offset", F.coalesce(F.sum("in_cell").over(before), F.lit(0))).select(
        F.col("source").alias("s1"), F.col("size").alias("z1"), F.col("cell").alias("c1"), "offset"
    )
    dealt = copies.select(
        F.col("source").alias("s2"),
        F.col("size").alias("z2"),
        F.expr("copies div n").alias("whole"),
        (F.col("copies") % F.col("n")).alias("more"),
    )
    per_cell = (
        offsets.join(dealt, F.expr("s1 <=> s2 and z1 = z2"), "left")
        .join(goals.select(F.col("source").alias("s4"), "source_size", "target"), F.expr("s1 <=> s4"))
        .select("s1", "z1", "c1", "offset", "whole", "more", "source_size", "target")
    )
    rank = F.row_number().over(Window.partitionBy("source", "size", "cell").orderBy("h", "key")) - 1
    joined = sized.join(per_cell, F.expr("source <=> s1 and size = z1 and cell = c1"))
    taken = F.coalesce(F.col("whole") + (F.col("offset") + rank < F.col("more")).cast("long"), F.lit(0))
    return joined.withColumn("copies", taken.cast("long")).select(
        F.col("key").alias(key),
        "size",
        F.col("source").alias(source),
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )
