"""Near-duplicates by exact Jaccard similarity of word shingles.

1. Each text becomes the set of its hashed shingles. Equal sets are one node, so a
   group of copies of any size is one row.
2. SimHash groups of all texts, found through vantage-point trees by ``simhash``, give
   candidates: the group of a set's first text is a key of the set. MinHash bands give
   those that 64 bits miss: two sets of similarity s share a band with probability
   1 - (1 - s ** rows) ** bands. Each key links its nodes to the smallest one, so a
   common key gives one row per node, never all pairs.
3. Two sets that share a key are linked if their exact similarity is high enough.
   Components of the unverified links are families. The sets of a small family
   meet in one group of a shuffle.
4. A larger family is compared in groups of bounded weight: first each set with the
   one it shares most keys with; then, for every key whose sets are not all linked by
   then, blocks of those sets in pairs, of sizes that can be similar.

SimHash groups alone do not give all candidates: see the README for the distances of
such copies and for what vantage-point trees would copy at a radius that does.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import binaries, same, session_for, written
from bazaarlake.llm.simhash import SEED, components, near_groups, smallest_stay
from bazaarlake.operators.bits import bits_of, sharing
from bazaarlake.session import passing


@dataclass(frozen=True)
class Settings:
    """``share``: least similarity (in tenths of a thousand) of two linked texts.

    ``radius``: most bits by which SimHashes of a group's neighbours differ.
    ``most``: the weight of a block of sets. A set weighs its shingles and ``EACH``,
    which bounds both the memory and the comparisons of a block.
    """

    shingle: int = 5
    share: int = 8000
    radius: int = 2
    bands: int = 40
    rows: int = 8
    seed: int = 23
    most: int = 2_000_000


EACH = 2000
UNIT = ["kind", "key", "class_a", "block_a", "class_b", "block_b"]


def shingles(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; none without words.

    A text shorter than one shingle is hashed as a whole.
    """
    tokens = text.lower().split()  # bytes: lower-cases A-Z, splits at ASCII space
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_digest
    if len(tokens) <= size:
        found = digest(joined, SEED)
    else:
        ends = np.cumsum([len(t) + 1 for t in tokens]).tolist()
        starts = [0, *ends]
        found = b"".join([digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[size - 1 :])])
    return np.unique(np.frombuffer(found, ">u8").astype(np.uint64))


def node_of(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


class Bands:
    """Keys of a set of hashes, one per band."""

    def __init__(self, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        count = settings.bands * settings.rows
        self.times = rng.integers(0, 2**32, (count, 1), np.uint32) | np.uint32(1)
        self.flips = rng.integers(0, 2**32, (count, 1), np.uint32)
        self.bands = settings.bands

    def keys(self, hashes: np.ndarray) -> list[int]:
        if not len(hashes):
            return []
        low = np.full(len(self.times), 2**32 - 1, np.uint32)
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        for start in range(0, len(short), 1000):
            mixed = (short[None, start : start + 1000] ^ self.flips) * self.times
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x2C1B3C6D)
            np.minimum(low, mixed.min(axis=1), out=low)
        rows = low.reshape(self.bands, -1)
        return [xxhash.xxh64_intdigest(r.tobytes(), band) for band, r in enumerate(rows)]


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def linked(
    sets: list[np.ndarray],
    share: int,
    may: Callable[[int, np.ndarray], np.ndarray] | None = None,
    alike: np.ndarray | None = None,
) -> np.ndarray:
    """For each set the first of those it is linked with, directly or through others.

    ``may(x, others)`` tells which of the others x is compared with. Sets with equal
    numbers in ``alike`` are known to be linked.
    """
    root = np.arange(len(sets))
    alike = root if alike is None else alike
    sizes = np.array([len(s) for s in sets])
    places = np.unique(np.concatenate(sets), return_inverse=True)[1]
    own = np.split(places, np.cumsum(sizes)[:-1])
    mark = np.zeros(len(places), bool)
    left = np.arange(len(sets))
    while len(left):
        first = left[0]
        known = alike[left] == alike[first]
        queue, left = left[known].tolist(), left[~known]
        root[queue] = first
        while queue and len(left):
            x = queue.pop()
            fits = (sizes[left] * 10_000 >= share * sizes[x]) & (sizes[x] * 10_000 >= share * sizes[left])
            if may is not None:
                fits &= may(x, left)
            near = left[fits]
            if not len(near):
                continue
            mark[own[x]] = True
            starts = np.concatenate([[0], np.cumsum(sizes[near])[:-1]])
            both = np.add.reduceat(mark[np.concatenate([own[i] for i in near])], starts, dtype=np.int64)
            mark[own[x]] = False
            hit = near[both * 10_000 >= share * (sizes[x] + sizes[near] - both)]
            if len(hit):
                hit = left[np.isin(alike[left], alike[hit])]
                root[hit] = first
                queue += hit.tolist()
                left = left[~np.isin(left, hit)]
    return root


def _nodes(docs: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """``id fp keys size seen``: a row per document; ``seen`` is a hash of its text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(settings)
        for batch in batches:
            sets = [shingles(t, settings.shingle) for t in binaries(batch, "text")]
            keys = [_signed(bands.keys(s)) for s in sets]
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(_signed([node_of(s) for s in sets])),
                    pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()), pa.array(np.concatenate([*keys, np.empty(0, np.int64)]))
                    ),
                    pa.array([len(s) for s in sets], pa.int64()),
                    batch.column("seen"),
                ],
                names=["id", "fp", "keys", "size", "seen"],
            )

    return _hashed(docs, id_col, text_col).mapInArrow(
        run, f"id {id_type}, fp bigint, keys array<bigint>, size bigint, seen bigint"
    )


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("seen"), text.alias("text"))


def _trees(docs: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """``seen tree``: the smallest text of its SimHash group, for each text that has others near."""
    texts = _hashed(docs, id_col, text_col).select("seen", "text")
    groups = near_groups(texts, settings.shingle, settings.radius, "seen", "text")
    near = groups.filter("id <> component").select(F.col("id").alias("seen"), F.col("component").alias("tree"))
    near = near.unionByName(near.select(F.col("tree").alias("seen"), "tree"))
    return near.groupBy("seen").agg(F.min("tree").alias("tree"))


def _keyed(nodes: DataFrame) -> DataFrame:
    return nodes.select("fp", F.explode("keys").alias("key"))


def _shared_keys(nodes: DataFrame) -> DataFrame:
    """``key low``: the keys of several nodes and the smallest of those."""
    ends = _keyed(nodes).groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    return ends.filter("low < high").select("key", "low")


def _candidates(nodes: DataFrame, shared: DataFrame) -> DataFrame:
    """Links ``a``, ``b``: each node to the smallest one of each of its keys, ``shared`` of them."""
    return (
        _keyed(nodes)
        .join(shared, "key")
        .filter("fp > low")
        .groupBy(F.col("fp").alias("a"), F.col("low").alias("b"))
        .agg(F.count("*").alias("shared"))
    )


def similar_groups(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``id``, ``fp`` (of its set) and ``component``, the smallest id linked.

    NULL text is an empty text; texts without words are one group. A NULL id never
    is a component's id unless all its ids are NULL. Equal rows give equal result
    rows; no rows give none. No group of a shuffle weighs more than two blocks of ``most``, but
    for a block of one heavier text.
    """
    trees = written(_trees(docs, settings, id_col, text_col), "trees")
    session_for(docs)
    with passing(_nodes(docs, settings, id_col, text_col), "shingle_sets") as rows:
        one = rows.groupBy("fp").agg(
            F.min(F.struct("id", "seen")).alias("one"), F.any_value("keys").alias("keys"), F.any_value("size").alias("size")
        )
        one = one.select("fp", "one.*", "keys", "size").join(trees, "seen", "left")
        # A text without others near is a group of its own. Texts without words have no key.
        tree = F.array(F.xxhash64(F.lit("tree"), F.coalesce("tree", "seen")))
        keys = F.when(F.size("keys") > 0, F.concat("keys", tree)).otherwise(F.col("keys"))
        with passing(one.select("fp", "id", "seen", keys.alias("keys"), "size"), "nodes") as nodes:
            member = _members(docs, nodes, settings, id_col, text_col)
            placed = rows.select("id", "fp").join(member, "fp").select("id", "fp", "component")
            return written(placed, "groups")


def _unit(*parts: Column) -> Column:
    """Name of a group of sets that meet: UNIT, zero where not given."""
    given = [p.cast("long") for p in parts] + [F.lit(0).cast("long")] * (len(UNIT) - len(parts))
    return F.struct(*[p.alias(n) for p, n in zip(given, UNIT, strict=True)]).alias("unit")


def _blocks(weight: Column, settings: Settings) -> Column:
    return F.ceil(weight / settings.most).cast("long")


def _block(blocks: str | Column) -> Column:
    return F.pmod(F.xxhash64("fp"), blocks)


def _star_units(large: DataFrame, edges: DataFrame, settings: Settings) -> DataFrame:
    """``fp unit side alike``: blocks of the sets that share most bands with the same one, and that one."""
    chosen = edges.groupBy(F.col("a").alias("fp")).agg(F.max(F.struct("shared", "b"))["b"].alias("b"))
    member = large.join(chosen, "fp").select("fp", "b", "weight")
    count = member.groupBy("b").agg(_blocks(F.sum("weight"), settings).alias("blocks"))
    placed = member.join(count, "b").select("fp", "b", _unit(F.lit(1), F.col("b"), _block("blocks")))
    middle = placed.select(F.col("b").alias("fp"), "unit").distinct()
    return placed.select("fp", "unit").unionByName(middle).select(
        "fp", "unit", F.lit(0).alias("side"), F.col("fp").alias("alike")
    )


def _bucket_units(sets: DataFrame, settings: Settings) -> DataFrame:
    """``fp unit side alike`` from ``fp keys size weight alike``: all that is left to compare.

    Keys whose sets are all alike go, and of keys with the same sets all but one. The
    sets of a heavy key fall into classes of size, of which only equal and neighbouring
    ones can be similar, and classes into blocks. Each two blocks are a unit, in which
    only sets of different sides are compared; a block by itself is one as well.
    """
    keyed = sets.select("fp", "size", "weight", "alike", F.explode("keys").alias("key"))
    members = keyed.groupBy("key").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("fp")).alias("x"),
        F.sum(F.xxhash64("fp", F.lit(1)).cast("decimal(38,0)")).alias("s"),
        F.sum("weight").alias("total"),
        F.min("alike").alias("low"),
        F.max("alike").alias("high"),
    )
    open_keys = members.filter("low < high").groupBy("n", "x", "s").agg(
        F.min("key").alias("key"), F.any_value("total").alias("total")
    )
    # A class is a little wider than what two similar sets differ by.
    width = max(0.01, 1.001 * math.log(10_000 / settings.share))
    level = F.when(F.col("total") > settings.most, F.floor(F.log("size") / F.lit(width))).otherwise(0)
    keyed = keyed.join(open_keys.select("key", "total"), "key").withColumn("c", level.cast("long"))
    classes = keyed.groupBy("key", "c").agg(_blocks(F.sum("weight"), settings).alias("own"))
    along = Window.partitionBy("key").orderBy("c")  # classes of one key: few

    def beside(step: int) -> Column:
        there = F.lead("c", step).over(along) == F.col("c") + step
        return F.when(there, F.lead("own", step).over(along)).otherwise(0)

    classes = classes.withColumns({"after": beside(1), "before": beside(-1)})
    placed = keyed.join(classes, ["key", "c"]).withColumn("at", _block(F.col("own")))

    def meet(others: Column, one) -> Column:
        return F.transform(F.sequence(F.lit(0).cast("long"), others - 1), one)

    def unit(side: Column | int, *parts: Column) -> Column:
        side = F.lit(side) if isinstance(side, int) else side
        return F.struct(_unit(F.lit(2), F.col("key"), *parts), side.cast("int").alias("side"))

    c, at = F.col("c"), F.col("at")
    none = F.array().cast("array<struct<unit:struct<" + ",".join(f"{n}:bigint" for n in UNIT) + ">,side:int>>")
    inside = meet(
        F.col("own"),
        lambda j: unit(
            F.when(j == at, 0).when(at < j, 1).otherwise(2), c, F.least(at, j), c, F.greatest(at, j)
        ),
    )
    up = F.when(F.col("after") > 0, meet(F.col("after"), lambda j: unit(1, c, at, c + 1, j))).otherwise(none)
    down = F.when(F.col("before") > 0, meet(F.col("before"), lambda j: unit(2, c - 1, j, c, at))).otherwise(none)
    return placed.select("fp", "alike", F.explode(F.concat(inside, up, down)).alias("u")).select(
        "fp", "u.unit", "u.side", "alike"
    )


def _texts(docs: DataFrame, families: DataFrame, bits: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``fp text keys`` of the sets of families: their texts, read again."""
    wanted = families.select("fp", F.col("id").alias("one"), F.col("seen").alias("mark"))
    hashed = _hashed(docs, id_col, text_col)
    hashed = sharing(hashed, F.col("seen"), bits)  # other texts meet no shuffle
    texts = hashed.join(wanted, same(hashed["id"], wanted["one"]) & (hashed["seen"] == wanted["mark"]))
    # Keys come after the texts: with them the wanted rows would be too many to broadcast sooner.
    return texts.groupBy("fp").agg(F.any_value("text").alias("text")).join(families.select("fp", "keys"), "fp")


def _verified(texts: DataFrame, units: DataFrame, settings: Settings) -> DataFrame:
    """``fp root kind``: the sets linked to another of their unit."""

    def verify(group: pa.Table) -> pa.Table:
        group = group.sort_by("fp")
        kind = group.column("unit")[0].as_py()["kind"]
        sets = [shingles((t or "").encode(), settings.shingle) for t in group.column("text").to_pylist()]
        fps, side = group.column("fp").to_numpy(), group.column("side").to_numpy()
        may = None
        if kind < 2:  # sets of a bucket share its key, others any one
            keys = np.array(group.column("keys").to_pylist())
            may = lambda x, others: (keys[others] == keys[x]).any(axis=1)
        elif side[0]:
            may = lambda x, others: side[others] != side[x]
        root = fps[linked(sets, settings.share, may, group.column("alike").to_numpy())]
        moved = root != fps
        return pa.table(
            {"fp": fps[moved], "root": root[moved], "kind": np.full(int(moved.sum()), kind, np.int64)}
        )

    met = texts.join(units, "fp").withColumn("keys", F.when(F.col("unit.kind") < 2, F.col("keys")))
    return written(met.groupBy("unit").applyInArrow(verify, "fp bigint, root bigint, kind bigint"), "verified")


def _members(
    docs: DataFrame, nodes: DataFrame, settings: Settings, id_col: str, text_col: str
) -> DataFrame:
    """``fp component`` of every node."""
    with passing(_shared_keys(nodes), "shared_keys") as shared:
        edges = written(_candidates(nodes, shared), "edges")
    if edges.isEmpty():
        return nodes.select("fp", F.col("id").alias("component"))
    family = components(edges).select(F.col("node").alias("fp"), F.col("root").alias("family"))
    family = family.unionByName(family.select(F.col("family").alias("fp"), "family").distinct())
    weighed = family.join(nodes.withColumn("weight", F.col("size") + EACH), "fp")
    with passing(weighed, "families") as families:
        with passing(bits_of(families, "seen"), "family_bits") as bits:
            found = _texts(docs, families, bits, id_col, text_col)
            with passing(found, "family_texts") as texts:
                roots = written(_roots(families, edges, texts, settings), "roots")
    placed = nodes.select("fp", "id").join(roots, "fp", "left").select("fp", "id", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("id").alias("component"))
    return placed.select("fp", "root").join(named, "root").select("fp", "component")


def _roots(families: DataFrame, edges: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """``fp root`` of the sets linked to others of their family."""
    total = families.groupBy("family").agg(F.sum("weight").alias("total"))
    weighed = families.select("family", "fp", "weight").join(total, "family")
    large = weighed.filter(F.col("total") > settings.most)
    small = weighed.filter(F.col("total") <= settings.most).select(
        "fp", _unit(F.lit(0), F.col("family")), F.lit(0).alias("side"), F.col("fp").alias("alike")
    )
    units = written(small.unionByName(_star_units(large, edges, settings)), "units")
    first = _verified(texts, units, settings)
    roots = first.filter("kind = 0").select("fp", "root")
    if large.isEmpty():
        return roots
    links = first.filter("kind = 1").select(F.col("fp").alias("a"), F.col("root").alias("b"))
    known = components(links).select(F.col("node").alias("fp"), F.col("root").alias("alike"))
    sets = (
        large.select("fp", "weight")
        .join(families.select("fp", "keys", "size"), "fp")
        .join(known, "fp", "left")
        .withColumn("alike", F.coalesce("alike", "fp"))
    )
    units = written(_bucket_units(sets, settings), "units")
    second = _verified(texts, units, settings)
    # A unit names one set of those known to be linked with a set.
    links = links.unionByName(second.select(F.col("fp").alias("a"), F.col("root").alias("b")))
    return roots.unionByName(components(links).select(F.col("node").alias("fp"), "root"))


def keep_one(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents less near-duplicates, with the rules of ``smallest_stay``."""

    @F.arrow_udf("bigint")
    def fp(text: pa.Array) -> pa.Array:
        values = [t.encode() if t is not None else b"" for t in text.to_pylist()]
        return pa.array(_signed([node_of(shingles(v, settings.shingle)) for v in values]))

    groups = similar_groups(docs, settings, id_col, text_col)
    return smallest_stay(docs, groups, lambda df, name: df.withColumn(name, fp(F.col(f"`{text_col}`"))), id_col)
