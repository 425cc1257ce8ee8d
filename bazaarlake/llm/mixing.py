"""Mixing sources to target weights by weighted fair queueing.

Every source offers its documents in a fixed random order, as often as the
epochs allow. A copy's virtual finish time is the number of words its source has
offered up to and with it, divided by the source's target. Sorted by that time,
all sources advance in proportion to their targets; the mix is what comes before
the total budget is used up.

Both running sums are exact whole numbers and cut into ranges: ranges of the
random order within a source, so that a source with a third of all rows is many
groups, and ranges of virtual time over the whole mix. Only the totals of the
ranges, whose number follows from the row count, meet in one window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import SPACES, same, words, written
from bazaarlake.session import tune

RANGE_ROWS = 20_000


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def targets(
    sizes: DataFrame, weights: Sequence[int], share: float, most: float
) -> DataFrame:
    """``source``, ``source_size``, ``target`` for one row per source.

    Sources in code-point order, NULL last, get the weights in turn and share
    ``share`` times all sizes. A target stops at ``most`` times its source's size;
    the excess is shared again by weight until no target is above. Filling
    sources in order of limit / weight gives that fixed point: a source is at its
    limit if even the smallest level that serves the rest exceeds it.
    """
    one = Window.orderBy(F.asc_nulls_last("source"))
    turn = (F.row_number().over(one) - 1) % len(weights)
    given = sizes.withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    ).withColumn("limit", F.col("source_size") * F.lit(most))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    level = (
        F.sum("source_size").over(everything) * F.lit(share)
        - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ) / F.sum("weight").over(after)
    filled = given.withColumn("level", level).withColumn(
        "open", F.col("level") * F.col("weight") < F.col("limit")
    )
    # The first source below its limit fixes the level of it and all after it.
    first = F.min(F.when(F.col("open"), F.col("level"))).over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    level = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    return filled.withColumn("at", level).select(
        "source",
        "source_size",
        F.when(F.col("at").isNull() | first.isNull(), F.col("limit"))
        .otherwise(F.least(F.col("at") * F.col("weight"), F.col("limit")))
        .alias("target"),
    )


def offers(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    seed: int = 7,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """A slim row per document: id, source, size, shuffle key, running source total.

    ``key`` orders the documents of a source at random but always alike; equal
    rows have equal keys and are interchangeable.
    """
    tune(docs.sparkSession)
    source = F.col(f"`{source_col}`")
    text = F.col(f"`{text_col}`")
    ident = F.col(f"`{id_col}`")
    slim = written(
        docs.select(
            ident.alias("id"),
            source.alias("source"),
            n_words(text).alias("size"),
            F.xxhash64(F.lit(seed), ident, source, text).alias("key"),
        ),
        "sizes",
    )
    total = slim.count()
    ranges = max(1, -(-total // RANGE_ROWS))
    slim = slim.withColumn("part", F.pmod(F.shiftrightunsigned("key", 20), F.lit(ranges)))
    parts = slim.groupBy("source", "part").agg(F.sum("size").alias("in_part"))
    parts = written(parts, "parts")
    by_source = Window.partitionBy("source").orderBy("part")
    parts = parts.withColumn("before", F.sum("in_part").over(by_source) - F.col("in_part"))
    sources = parts.groupBy("source").agg(F.sum("in_part").alias("source_size"))
    goal = targets(sources, weights, share, most)
    marks = parts.select(
        F.col("source").alias("s"), F.col("part").alias("p"), "before"
    ).join(
        goal.select(F.col("source").alias("t"), "source_size", "target"),
        same(F.col("s"), F.col("t")),
    )
    inside = Window.partitionBy("source", "part").orderBy("key", "id", "size")
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    run = slim.withColumn("run", upto)
    return run.join(
        marks, same(F.col("source"), F.col("s")) & (F.col("part") == F.col("p"))
    ).select(
        "id", "source", "size", "key", "source_size", "target", (F.col("before") + F.col("run")).alias("upto")
    )


def schedule(offered: DataFrame, epochs: int = 2) -> DataFrame:
    """The copies in the mix: ``id source size key copy finish`` and ``place``.

    ``place`` is the number of words that the mix has up to and with the copy.
    Copies without words take nothing and are left out.
    """
    copies = offered.filter("size > 0").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("copy")
    )
    finish = (F.col("upto") + F.col("copy") * F.col("source_size")) / F.col("target")
    # No copy can end before the budget if its source alone is far past its target.
    copies = written(copies.withColumn("finish", finish).drop("upto"), "copies")
    total = copies.count()
    ranges = max(1, -(-total // RANGE_ROWS))
    copies = copies.withColumn("part", F.floor(F.col("finish") * ranges))
    parts = copies.groupBy("part").agg(F.sum("size").alias("in_part"))
    one = Window.orderBy("part")
    before = parts.select(
        F.col("part").alias("p"), (F.sum("in_part").over(one) - F.col("in_part")).alias("before")
    )
    inside = Window.partitionBy("part").orderBy("finish", "key", "id", "copy", "size")
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return copies.withColumn("run", upto).join(before, F.col("part") == F.col("p")).select(
        "id", "source", "size", "key", "copy", "finish", (F.col("before") + F.col("run")).alias("place")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    seed: int = 7,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """Per document: ``id source size source_size target`` and ``copies`` taken.

    A copy is taken while the words up to and with it stay within the budget, the
    sum of the targets, so a source ends within one document of its target and no
    document is taken more than ``most`` times. NULL text has size 0 and is never
    taken; a NULL source is a source, in last place. Of equal rows any may be the
    one taken. No rows give none. Reruns agree.
    """
    offered = written(
        offers(docs, weights, share, most, seed, id_col, source_col, text_col), "offers"
    )
    placed = schedule(offered, most)
    budget = (
        offered.groupBy("source").agg(F.max("target").alias("t")).agg(F.sum("t")).first()[0] or 0.0
    )
    taken = placed.filter(F.col("place") <= F.lit(float(budget)))
    row = ["id", "source", "size", "key"]
    count = taken.groupBy(*row).agg(F.count("*").alias("copies"))
    # Equal rows share their copies as evenly as possible.
    alike = Window.partitionBy(*row)
    ranked = offered.withColumns(
        {
            "nth": F.row_number().over(alike.orderBy("upto")),
            "rows": F.count("*").over(alike),
        }
    )
    on = [same(ranked[c], count[c]) for c in row]
    copies = F.coalesce(F.col("copies"), F.lit(0))
    return ranked.join(count, on, "left").select(
        *[ranked[c] for c in row],
        "source_size",
        "target",
        "nth",
        (
            F.floor(copies / F.col("rows"))
            + F.when(F.col("nth") <= copies % F.col("rows"), 1).otherwise(0)
        )
        .cast("int")
        .alias("copies"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, a row for each copy, with the columns of ``docs``."""
    names = {k: options.get(k, v) for k, v in (("id_col", "doc_id"), ("source_col", "source"), ("text_col", "text"))}
    seed = options.get("seed", 7)
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.xxhash64(
            F.lit(seed), *[F.col(f"`{names[k]}`") for k in ("id_col", "source_col", "text_col")]
        ).alias("k"),
        F.col(f"`{names['id_col']}`").alias("i"),
    )
    plan = (
        mix(docs, **options)
        .groupBy("id", "key")
        .agg(F.sum("copies").alias("copies"), F.count("*").alias("n"))
        .filter("copies > 0")
    )
    on = same(F.col("i"), F.col("id")) & (F.col("k") == F.col("key"))
    # Equal rows are told apart only where there are any: by an arbitrary number.
    hit = keyed.join(plan, on)
    nth = F.row_number().over(Window.partitionBy("id", "key").orderBy(F.lit(1)))
    once = hit.filter("n = 1").select("row", "copies")
    several = hit.filter("n > 1").withColumn("nth", nth)
    several = several.select(
        "row",
        (
            F.floor(F.col("copies") / F.col("n"))
            + F.when(F.col("nth") <= F.col("copies") % F.col("n"), 1).otherwise(0)
        ).alias("copies"),
    )
    return (
        once.unionByName(several)
        .filter("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select("row.*")
    )
