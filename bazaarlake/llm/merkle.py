"""Merkle manifest of a table: a digest per row, a tree per group, a root over the groups.

Rows get their place in the group's order and form blocks of ``fanout ** levels``
places. A block hashes its own subtree. Then blocks exchange roots in rounds, as in a
butterfly: in a round each block holds the root of the unit it belongs to (the block
itself, then the run of ``fanout`` units, and so on), takes the roots of the other
units of its run from one block each, and hashes the run's root itself. So each block
gathers the proof of its unit on the way up, and nothing has to come down again. Once
a group is one unit, the groups go on in the same way as units of one tree.

Units differ in size at the end of a group, and groups differ anyway. A block at
place ``p`` of a unit of ``m`` blocks sends to the places p, p + m, p + 2m ... of the
other units: each place receives once from every unit of its run, and a large unit
shares the sending among its blocks.

A digest is lower-case hexadecimal SHA-256; digests are hashed as that text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import written
from bazaarlake.session import tune

DIGEST = 64


@dataclass(frozen=True)
class Settings:
    """``fanout ** levels`` rows make a block, the unit of one task's work."""

    fanout: int = 3
    levels: int = 8


def field(value: Column) -> Column:
    """``-`` for NULL, else the UTF-8 byte count, a colon, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def _numbered(rows: DataFrame, group: str, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` with ``place`` in the order of the group and the group's ``size``, from 0.

    Sorted ranges number their own rows; only counts per range and group meet in a
    window, so a group with most rows is many tasks. Written once: the numbers of the
    partitions must be those that were counted.
    """
    ranges = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    laid = written(
        ranges.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")),
        label,
    )
    counts = laid.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    ordered = Window.partitionBy(group).orderBy("_part")
    whole = Window.partitionBy(group)
    before = F.sum("_n").over(ordered) - F.col("_n") - F.col("_first")
    marks = counts.select(
        F.col(group).alias("_g"),
        F.col("_part").alias("_p"),
        before.alias("_shift"),
        F.sum("_n").over(whole).alias("size"),
    )
    same = F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p"))
    return laid.join(marks, same).withColumn("place", F.col("_at") + F.col("_shift")).drop(
        "_part", "_at", "_g", "_p", "_shift"
    )


def _tree(leaves: list[str], levels: int, fanout: int) -> list[list[str]]:
    """The leaves, then the nodes of each level above them."""
    out = [leaves]
    for _ in range(levels):
        below = out[-1]
        out.append(
            [
                sha256("".join(below[i : i + fanout]).encode()).hexdigest()
                for i in range(0, len(below), fanout)
            ]
        )
    return out


def _levels(size: int, settings: Settings) -> int:
    """Levels inside a block of a group with so many rows."""
    block, up = settings.fanout**settings.levels, 0
    while size <= block and settings.fanout**up < size:
        up += 1
    return up if size <= block else settings.levels


def _block_roots(placed: DataFrame, settings: Settings) -> DataFrame:
    """``grp block size node``: the root of every block; ``size`` in rows of its group."""

    def root(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        size = group.column("size")[0].as_py()
        top = _tree(group.column("leaf").to_pylist(), _levels(size, settings), settings.fanout)[-1]
        one = group.slice(0, 1).select(["grp", "block", "size"])
        return one.append_column("node", pa.array(top, pa.string()))

    slim = placed.select("grp", "block", "size", "place", "leaf")
    return slim.groupBy("grp", "block").applyInArrow(
        root, "grp bigint, block bigint, size bigint, node string"
    )


def _round(blocks: DataFrame, fanout: int) -> DataFrame:
    """One exchange. ``blocks`` has ``tree unit place size others``.

    ``others`` are the units of the run, ascending by unit: (unit, size, shift), where
    ``shift`` is the place of the unit's first block in the run. A unit alone in its
    tree stays as it is (``others`` is NULL).
    """
    run = F.call_function("div", F.col("unit"), F.lit(fanout))
    ends = F.transform(
        "others",
        lambda o: F.struct(
            o["unit"].alias("unit"),
            F.when(F.col("place") < o["size"], F.sequence(F.col("place"), o["size"] - 1, F.col("size")))
            .otherwise(F.array().cast("array<bigint>"))
            .alias("places"),
            o["shift"].alias("shift"),
        ),
    )
    sent = (
        blocks.filter("others IS NOT NULL")
        .select("*", run.alias("run"), F.explode(ends).alias("to"))
        .select("*", F.explode("to.places").alias("at"))
        .select(
            "tree",
            F.col("run").alias("unit"),
            (F.col("to.shift") + F.col("at")).alias("place"),
            F.struct(F.col("unit").alias("u"), "node").alias("told"),
            # What a block keeps comes from itself.
            F.when(
                (F.col("to.unit") == F.col("unit")) & (F.col("at") == F.col("place")),
                F.struct(F.col("unit").alias("u"), "grp", "block", "proof", "steps"),
            ).alias("own"),
        )
    )
    met = sent.groupBy("tree", "unit", "place").agg(
        F.array_sort(F.collect_list("told")).alias("told"), F.max_by("own", F.col("own").isNotNull()).alias("own")
    )
    earlier = F.filter("told", lambda t: t["u"] < F.col("own.u"))
    later = F.filter("told", lambda t: t["u"] > F.col("own.u"))

    def joined(some: Column) -> Column:
        return F.array_join(F.transform(some, lambda t: t["node"]), "")

    return met.select(
        "own.grp",
        "own.block",
        "tree",
        "unit",
        "place",
        F.sha2(joined(F.col("told")), 256).alias("node"),
        F.concat("own.proof", joined(earlier), joined(later)).alias("proof"),
        F.concat("own.steps", F.array(F.size(earlier), F.size(later))).alias("steps"),
    )


def _up_the_groups(blocks: DataFrame, fanout: int, label: str) -> DataFrame:
    """Rounds until every group is one unit; all units but the last of a group are full."""
    blocks = blocks.select(
        "grp",
        "block",
        F.col("grp").alias("tree"),
        F.col("block").alias("unit"),
        F.lit(0).cast("bigint").alias("place"),
        "node",
        F.lit("").alias("proof"),
        F.array().cast("array<int>").alias("steps"),
        "n_blocks",
    )
    most = blocks.agg(F.max("n_blocks")).first()[0] or 1
    span = 1
    while span < most:
        n = F.col("n_blocks")
        first = F.call_function("div", F.col("unit"), F.lit(fanout)) * fanout
        units = F.call_function("div", n + (span - 1), F.lit(span))
        others = F.when(
            n > span,
            F.transform(
                F.sequence(first, F.least(first + (fanout - 1), units - 1)),
                lambda u: F.struct(
                    u.alias("unit"),
                    F.least(F.lit(span), n - u * span).alias("size"),
                    ((u - first) * span).alias("shift"),
                ),
            ),
        )
        held = F.least(F.lit(span), n - F.col("unit") * span)
        state = blocks.withColumns({"others": others, "size": held})
        counts = blocks.select("grp", "n_blocks").distinct()
        done = blocks.filter(n <= span)
        moved = _round(state, fanout).join(counts, "grp")
        blocks = written(done.unionByName(moved.select(*blocks.columns)), label)
        span *= fanout
    return blocks


def _up_to_the_root(blocks: DataFrame, n_groups: int, fanout: int, label: str) -> DataFrame:
    """Rounds in which whole groups are the first units, until all blocks hold the root.

    ``grp`` numbers the groups in order. Sizes of units are sums over the groups; a
    table of them has a row per run.
    """
    blocks = blocks.select(
        "grp", "block", F.lit(0).cast("bigint").alias("tree"), F.col("grp").alias("unit"),
        F.col("block").alias("place"), "node", "proof", "steps",
    )
    sizes = written(blocks.groupBy("unit").agg(F.count("*").alias("size")), f"{label}_sizes")
    while n_groups > 1:
        run = F.call_function("div", F.col("unit"), F.lit(fanout))
        listed = sizes.groupBy(run.alias("_run")).agg(
            F.array_sort(F.collect_list(F.struct("unit", "size"))).alias("_list")
        )
        before = F.transform(
            "_list",
            lambda u: F.struct(
                u["unit"].alias("unit"),
                u["size"].alias("size"),
                F.aggregate(
                    F.filter("_list", lambda v: v["unit"] < u["unit"]),
                    F.lit(0).cast("bigint"),
                    lambda acc, v: acc + v["size"],
                ).alias("shift"),
            ),
        )
        state = (
            blocks.join(listed, run == F.col("_run"))
            .withColumn("others", before)
            .withColumn(
                "size", F.filter("others", lambda o: o["unit"] == F.col("unit"))[0]["size"]
            )
            .drop("_run", "_list")
        )
        blocks = written(_round(state, fanout).select(*blocks.columns), label)
        sizes = sizes.groupBy(run.alias("unit")).agg(F.sum("size").alias("size"))
        n_groups = -(-n_groups // fanout)
    return blocks


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group_col: str = "source",
    order_col: str = "doc_id",
    settings: Settings = Settings(),
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row: ``id``, ``leaf``, ``proof``, ``steps``, ``subroot``, ``root`` and ``also``.

    ``proof`` is the digests of the leaf's siblings, one after the other, level by
    level; ``steps`` has two numbers a level, the siblings before and after the node.
    ``also`` are further columns of ``docs`` to carry along.

    Groups are ordered by their bytes, NULL first and apart from ''. Rows of a group
    with equal ``order_col`` are ordered by their leaves, so equal rows have places of
    their own in any order; a NULL one comes first. No rows give none.
    """
    tune(docs.sparkSession)
    also, fanout = also or {}, settings.fanout
    group = F.col(f"`{group_col}`")
    slim = written(
        docs.select(
            F.col(f"`{order_col}`").alias("id"),
            group.cast("string").alias("grp"),
            leaf_of([F.col(f"`{c}`") for c in columns]).alias("leaf"),
            *[c.alias(f"also_{name}") for name, c in also.items()],
        ),
        "leaves",
    )
    numbered = _numbered(slim, "grp", ["id", "leaf"], "ordered_leaves")
    groups = numbered.groupBy(F.col("grp").alias("name")).agg(F.count("*").alias("n"))
    groups = written(groups.withColumn("all", F.lit(0)), "groups")
    ranks = _numbered(groups, "all", ["name"], "ordered_groups").select(
        "name", F.col("place").alias("rank")
    )
    block = fanout**settings.levels
    placed = written(
        numbered.join(ranks, F.col("grp").eqNullSafe(F.col("name")))
        .drop("grp", "name")
        .withColumnRenamed("rank", "grp")
        .withColumn("block", F.call_function("div", F.col("place"), F.lit(block))),
        "placed",
    )
    roots = _block_roots(placed, settings).withColumn(
        "n_blocks", F.call_function("div", F.col("size") + (block - 1), F.lit(block))
    )
    grouped = _up_the_groups(written(roots.drop("size"), "block_roots"), fanout, "exchange")
    top = _up_to_the_root(grouped.drop("n_blocks"), groups.count(), fanout, "exchange")
    upper = grouped.select("grp", "block", F.col("node").alias("subroot")).join(
        top.select("grp", "block", F.col("node").alias("root"), "proof", "steps"), ["grp", "block"]
    )
    carried = [f"also_{name}" for name in also]
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema.fields}

    def proofs(group: pa.Table, above: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        size = group.column("size")[0].as_py()
        up = _levels(size, settings)
        tree = _tree(group.column("leaf").to_pylist(), up, fanout)
        (proof, steps, subroot, root) = (above.column(c)[0].as_py() for c in ("proof", "steps", "subroot", "root"))
        texts, shapes = [], []
        for at in range(group.num_rows):
            own, shape = [], []
            for level in tree[:up]:
                first = at - at % fanout
                run = level[first : first + fanout]
                own += run[: at - first] + run[at - first + 1 :]
                shape += (at - first, len(run) - 1 - (at - first))
                at //= fanout
            texts.append("".join(own) + proof)
            shapes.append(shape + steps)
        out = group.select(["id", "leaf", *carried])
        for name, column in (
            ("proof", pa.array(texts, pa.string())),
            ("steps", pa.array(shapes, pa.list_(pa.int32()))),
            ("subroot", pa.array([subroot] * len(texts), pa.string())),
            ("root", pa.array([root] * len(texts), pa.string())),
        ):
            out = out.append_column(name, column)
        return out

    fields = [f"{c} {kinds[c]}" for c in ["id", "leaf", *carried]]
    fields += ["proof string", "steps array<int>", "subroot string", "root string"]
    out = (
        placed.groupBy("grp", "block")
        .cogroup(upper.groupBy("grp", "block"))
        .applyInArrow(proofs, ", ".join(fields))
    )
    return out.withColumnsRenamed({f"also_{name}": name for name in also})


def folded(leaf: Column, proof: Column | str, steps: Column | str) -> Column:
    """The root that a leaf and the siblings of its manifest row give."""
    proof = F.col(proof) if isinstance(proof, str) else proof
    steps = F.col(steps) if isinstance(steps, str) else steps
    start = F.struct(leaf.alias("node"), F.lit(0).alias("at"))
    each = F.transform(
        F.sequence(F.lit(0), F.call_function("div", F.size(steps), F.lit(2)).cast("int")),
        lambda i: F.struct(F.get(steps, i * 2).alias("before"), F.get(steps, i * 2 + 1).alias("after")),
    )
    levels = F.filter(each, lambda s: s["before"].isNotNull())

    def up(state: Column, step: Column) -> Column:
        before, after = step["before"] * DIGEST, step["after"] * DIGEST
        earlier = F.substr(proof, state["at"] + 1, before)
        later = F.substr(proof, state["at"] + 1 + before, after)
        return F.struct(
            F.sha2(F.concat(earlier, state["node"], later), 256).alias("node"),
            (state["at"] + before + after).alias("at"),
        )

    return F.aggregate(levels, start, up, lambda state: state["node"])
