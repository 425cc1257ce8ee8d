"""SimHash near-duplicates: fingerprints linked through vantage-point trees.

1. Each text gets a 64-bit fingerprint in one pass over Arrow batches.
2. Equal fingerprints become one node, so a group of copies of any size is one row.
3. A bounded sample of the nodes fixes the top of a vantage-point tree. A node with
   distance at most the median belongs to the near branch; one with distance above
   the median less the radius belongs to the far branch. So a node near a boundary
   goes to both, and two nodes within the radius always share a leaf: if the median
   splits them, the triangle bound puts the nearer one into the far branch too.
4. Each leaf (a shard, one group of a shuffle) grows its own tree in the same way,
   compares its smallest leaves directly and returns a star of links per connected
   set, never all pairs.
5. The stars are joined to components by alternating star steps, each written to
   the shared folder.

The top tree has at most ``sample / 8`` shards, so shards grow beyond
``shard_rows`` when there are more nodes than ``sample * shard_rows / 8``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import binaries, free_name, same, session_for, written
from bazaarlake.operators.bits import bits_of, sharing

SEED = 42
_FLIPS = np.concatenate(
    [np.zeros(1, np.uint64), np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))]
)


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority of the shingle hashes, bit by bit; 0 without words.

    A text shorter than one shingle is hashed as a whole. Ties give 0.
    """
    tokens = text.lower().split()  # bytes: lower-cases A-Z, splits at ASCII space
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= shingle:
        digests = xxhash.xxh64_digest(joined, SEED)
        n = 1
    else:
        ends = np.cumsum([len(t) + 1 for t in tokens]).tolist()
        starts = [0, *ends]
        n = len(tokens) - shingle + 1
        digest = xxhash.xxh64_digest
        digests = b"".join(
            [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[shingle - 1 :])]
        )
    bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(n, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def fingerprints(
    docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``id`` (as given) and ``fp`` (the 64 bits as a long).

    NULL text counts as empty. Repeated rows stay repeated.
    """
    session_for(docs)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in binaries(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(_signed(fps))], names=["id", "fp"]
            )

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"id {id_type}, fp bigint")


# ---------------------------------------------------------------- local trees


def _distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def _split(points: np.ndarray, radius: int, tries: int = 4):
    """Vantage and median that duplicate the fewest points, or None."""
    best = None
    for at in np.linspace(0, len(points) - 1, tries, dtype=np.int64):
        d = _distance(points, points[at])
        median = int(np.median(d))
        near, far = int((d <= median).sum()), int((d > median - radius).sum())
        if max(near, far) < len(points) * 0.9 and (best is None or near + far < best[0]):
            best = (near + far, points[at], median)
    return best and best[1:]


def top_tree(sample: np.ndarray, leaves: int, radius: int, first: int = 0):
    """Nested (vantage, median, near, far); a leaf is its number."""
    cut = _split(sample, radius) if leaves > 1 and len(sample) >= 16 else None
    if cut is None:
        return first, first + 1
    vantage, median = cut
    d = _distance(sample, vantage)
    near, middle = top_tree(sample[d <= median], leaves // 2, radius, first)
    far, end = top_tree(sample[d > median - radius], leaves - leaves // 2, radius, middle)
    return (vantage, median, near, far), end


def route(tree, points: np.ndarray, radius: int) -> list[tuple[int, np.ndarray]]:
    """(leaf, the points that belong to it) for every leaf that gets any."""
    out, stack = [], [(tree, points)]
    while stack:
        node, part = stack.pop()
        if not len(part):
            continue
        if isinstance(node, int):
            out.append((node, part))
            continue
        vantage, median, near, far = node
        d = _distance(part, vantage)
        stack.append((near, part[d <= median]))
        stack.append((far, part[d > median - radius]))
    return out


def _settle(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest label of each connected set, given links a-b between indices."""
    while True:
        low = np.minimum(labels[a], labels[b])
        new = labels.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, labels):
            return labels
        labels = new


def _star(points: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Links (member, smallest member) of the sets that a-b connects."""
    if not len(a):
        return np.empty((0, 2), np.uint64)
    labels = _settle(np.arange(len(points)), a, b)
    moved = np.flatnonzero(labels != np.arange(len(points)))
    return np.stack([points[moved], points[labels[moved]]], axis=1)


def _by_flips(points: np.ndarray, radius: int) -> np.ndarray:
    """Links of a leaf that no vantage point divides, in linear work.

    For a radius of 2: two fingerprints are that close exactly if they share a
    key, the keys of one being itself and itself with one bit flipped.
    """
    flips = _FLIPS if radius == 2 else _FLIPS[:1]
    at = np.tile(np.arange(len(points)), len(flips))
    keys = (points[None, :] ^ flips[:, None]).ravel()
    order = np.argsort(keys, kind="stable")
    equal = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    return _star(points, at[order[equal]], at[order[equal + 1]])


def link_leaf(points: np.ndarray, radius: int, leaf_rows: int = 256) -> np.ndarray:
    """Star links connecting all points within ``radius``, through a local tree."""
    points = np.unique(points)
    found, stack = [], [points]
    while stack:
        part = stack.pop()
        cut = _split(part, radius) if len(part) > leaf_rows else None
        if cut is not None:
            d = _distance(part, cut[0])
            stack += [part[d <= cut[1]], part[d > cut[1] - radius]]
        elif len(part) > 8 * leaf_rows and radius == 2:
            found.append(_by_flips(part, radius))
        else:
            for start in range(0, len(part), 512):
                rows = part[start : start + 512]
                close = np.bitwise_count(rows[:, None] ^ part[None, :]) <= radius
                a, b = np.nonzero(close)
                keep = a + start < b
                found.append(_star(part, a[keep] + start, b[keep]))
    links = np.concatenate(found) if found else np.empty((0, 2), np.uint64)
    return np.unique(links, axis=0) if len(links) else links


# ------------------------------------------------------------- distributed


def links(
    nodes: DataFrame, radius: int = 2, shard_rows: int = 8192, sample: int = 65536
) -> DataFrame:
    """Links ``a``, ``b`` (longs) that connect every two nodes within the radius.

    ``nodes`` has one row per distinct ``fp``. At most ``sample`` of them, chosen
    by a hash, are brought to the driver to place the vantage points; every node
    is indexed.
    """
    total = nodes.count()
    leaves = max(1, -(-total // shard_rows))
    every = max(1, total // min(sample, 64 * leaves))
    picked = (
        nodes.filter(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0)
        .select("fp")
        .orderBy(F.xxhash64(F.lit(1), F.col("fp")), "fp")
        .limit(sample)
        .toPandas()["fp"]
        .to_numpy(np.int64)
        .view(np.uint64)
    )
    tree, n_leaves = top_tree(picked, min(leaves, max(1, sample // 8)), radius)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column("fp").to_numpy().view(np.uint64)
            for leaf, part in route(tree, points, radius):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(part), leaf, np.int32)),
                        pa.array(part.view(np.int64)),
                    ],
                    names=["leaf", "fp"],
                )

    def link(group: pa.Table) -> pa.Table:
        points = group.column("fp").to_numpy().view(np.uint64)
        found = np.ascontiguousarray(link_leaf(points, radius).T).view(np.int64)
        return pa.table({"a": found[0], "b": found[1]})

    spark = nodes.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    return (
        nodes.select("fp")
        .mapInArrow(send, "leaf int, fp bigint")
        .groupBy("leaf")
        .applyInArrow(link, "a bigint, b bigint")
    )


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node``, ``root``: the smallest node of each linked set, from links a, b.

    Alternates two star steps until nothing changes. Each neighbourhood is only
    ever reduced to its minimum, so a node with very many links is no hot group.
    """
    pairs = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v")
        .distinct(),
        "links",
    )
    for _ in range(most_rounds):
        # Large star: every larger neighbour, and the node, to the smallest one.
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = large.unionByName(low.filter("u > m").select("u", F.col("m").alias("v")))
        large = large.filter("u <> v").distinct()
        # Small star: smaller neighbours of a node to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v")))
        new = written(small.filter("u <> v").distinct(), "links")
        moved = new.exceptAll(pairs).limit(1).count() or new.count() != pairs.count()
        pairs = new
        if not moved:
            break
    else:
        raise RuntimeError("links did not settle into components")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_groups(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_rows: int = 8192,
) -> DataFrame:
    """One row per document: ``id``, ``fp`` and ``component``, the smallest id linked.

    NULL text is an empty text; all empty texts share fingerprint 0. A NULL id is
    kept and never is a component's id unless all its ids are NULL. Equal rows
    give equal result rows; no rows give none.
    """
    rows = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("id").alias("id")), "nodes")
    edges = written(links(nodes, radius, shard_rows), "edges")
    if edges.isEmpty():
        return rows.join(nodes.select("fp", F.col("id").alias("component")), "fp").select(
            "id", "fp", "component"
        )
    linked = components(edges)
    placed = nodes.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("id").alias("component"))
    member = placed.select("fp", "root").join(named, "root").select("fp", "component")
    return rows.join(member, "fp").select("id", "fp", "component")


def keep_one(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents less near-duplicates: of each group the smallest id stays.

    Columns are those of ``docs``. Rows that repeat an id within a group count as
    copies: one row stays. Rows with a NULL id stay only as the sole member of
    their group; a group of NULL ids keeps one row.
    """
    groups = written(near_groups(docs, shingle, radius, id_col, text_col), "groups")
    return smallest_stay(
        docs, groups, lambda df, name: with_fingerprint(df, shingle, text_col, name), id_col
    )


def smallest_stay(
    docs: DataFrame,
    groups: DataFrame,
    marked: Callable[[DataFrame, str], DataFrame],
    id_col: str = "doc_id",
) -> DataFrame:
    """Of each component of ``groups`` (``id fp component``) the rows of the smallest id.

    ``marked(df, name)`` is ``df`` with each row's ``fp`` as column ``name``.
    """
    key, mark, best = (free_name(docs.columns, n) for n in ("kept_id", "kept_fp", "best_fp"))
    # Of each component, one (id, fingerprint) stays: the smallest.
    winners = written(
        groups.filter(same(F.col("id"), F.col("component")))
        .groupBy("component")
        .agg(F.min("fp").alias(mark), F.count("*").alias("n"))
        .select(F.col("component").alias(key), mark, "n"),
        "winners",
    )
    # An id of one row needs no fingerprint to be told apart from others.
    several = winners.groupBy(key).agg(F.sum("n").alias("n")).filter("n > 1").select(key)
    spread = groups.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
    several = written(
        several.unionByName(spread.select(F.col("id").alias(key))).distinct(), "repeated"
    )
    on = same(F.col(f"`{id_col}`"), F.col(key))
    # An id that is never another's copy stays: only rows that share a bit with one that
    # is need to be looked up.
    copies = groups.filter(~same(F.col("id"), F.col("component")))
    bits = written(bits_of(copies, "id"), "copy_bits")
    this = F.col(f"`{id_col}`").cast(groups.schema["id"].dataType)
    asked = sharing(docs, this, bits).join(winners.select(key), on, "left_semi")
    kept = sharing(docs, this, bits, "left_anti").unionByName(asked)
    if several.isEmpty():
        return kept
    again = marked(kept.join(several, on, "left_semi"), mark)
    chosen = again.join(
        winners.select(key, F.col(mark).alias(best)),
        on & (F.col(mark) == F.col(best)),
        "left_semi",
    ).dropDuplicates([id_col, mark])
    return kept.join(several, on, "left_anti").unionByName(chosen.select(*docs.columns))


def with_fingerprint(docs: DataFrame, shingle: int, text_col: str, name: str) -> DataFrame:
    """``docs`` with the fingerprint as column ``name``."""

    @F.arrow_udf("bigint")
    def fp(text: pa.Array) -> pa.Array:
        values = [t.encode() if t is not None else b"" for t in text.to_pylist()]
        return pa.array(_signed([fingerprint(v, shingle) for v in values]))

    session_for(docs)
    return docs.withColumn(name, fp(F.col(f"`{text_col}`")))
