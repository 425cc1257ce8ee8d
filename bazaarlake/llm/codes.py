"""Token ids in directly addressable codes.

An id is cut into chunks, lowest bits first. Level 0 holds a chunk of every id;
a bitmap tells which ids go on, and level 1 holds the next chunk of those only;
and so on. A rank directory (set bits before each block) leads from an id's
place on one level to its place on the next, so that any token is read by a few
short reads without decoding a block.

A shard file holds ``MAGIC``, the length of a JSON header (u32), the header and
the sections the header names with (start, bytes), all little-endian:
``doc_ids`` (i64), ``doc_nulls`` (u8), ``ends`` (u64: tokens up to and with each
document) and for each level ``codes``, ``more`` (bitmap) and ``ranks`` (u32).
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import session_for, written
from bazaarlake.llm.files import new_file, open_file, shared_folder, write_file
from bazaarlake.llm.tokens import encoder_for

MAGIC = b"DACIDS01"
BLOCK = 512  # bits of a bitmap that share a rank
_TYPES = {8: np.dtype("<u1"), 16: np.dtype("<u2"), 32: np.dtype("<u4")}


def pack(ids: np.ndarray, widths: Sequence[int]) -> list[dict[str, bytes]]:
    """Levels of the ids (u32). ``widths`` (8, 16 or 32 bits each) add up to 32."""
    levels, rest = [], ids.astype(np.uint32, copy=False)
    for at, width in enumerate(widths):
        level = {"codes": rest.astype(_TYPES[width]).tobytes()}  # keeps the low bits
        if at + 1 < len(widths):
            high = rest >> np.uint32(width)
            more = high != 0
            bits = np.packbits(more, bitorder="little")
            per_block = np.add.reduceat(more, np.arange(0, len(more), BLOCK)) if len(more) else []
            ranks = np.concatenate([[0], np.cumsum(per_block)]).astype("<u4")
            level |= {"more": bits.tobytes(), "ranks": ranks.tobytes()}
            rest = high[more]
        levels.append(level)
    return levels


def shard_parts(doc_ids, ends, ids: np.ndarray, widths: Sequence[int]) -> list[bytes]:
    """The pieces of a shard file in order."""
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    sections = {
        "doc_ids": np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        "doc_nulls": nulls.tobytes(),
        "ends": np.asarray(ends, "<u8").tobytes(),
    }
    for at, level in enumerate(pack(ids, widths)):
        sections |= {f"{name}{at}": data for name, data in level.items()}
    where, start = {}, 0
    for name, data in sections.items():
        where[name] = (start, len(data))
        start += len(data)
    header = json.dumps(
        {"widths": list(widths), "tokens": len(ids), "docs": len(doc_ids), "sections": where}
    ).encode()
    return [MAGIC, struct.pack("<I", len(header)), header, *sections.values()]


class Shard:
    """Reads a shard file: any token by its number, or everything in order."""

    def __init__(self, uri: str):
        self.file = open_file(uri)
        head = self.file.read_at(12, 0)
        if head[:8] != MAGIC:
            raise ValueError(f"{uri} is not a file of token codes")
        (size,) = struct.unpack("<I", head[8:])
        self.header = json.loads(self.file.read_at(size, 12))
        self.base = 12 + size
        self.widths = self.header["widths"]

    def close(self) -> None:
        self.file.close()

    def section(self, name: str, kind: str, first: int = 0, n: int | None = None) -> np.ndarray:
        start, size = self.header["sections"][name]
        item = np.dtype(kind).itemsize
        n = size // item - first if n is None else n
        return np.frombuffer(self.file.read_at(n * item, self.base + start + first * item), kind)

    def documents(self) -> tuple[list, np.ndarray]:
        """Ids (None for NULL) and ends."""
        ids = self.section("doc_ids", "<i8").tolist()
        nulls = self.section("doc_nulls", "u1")
        return [None if z else i for i, z in zip(ids, nulls)], self.section("ends", "<u8")

    def token(self, at: int) -> int:
        """The id at a place of the shard, by short reads only."""
        if not 0 <= at < self.header["tokens"]:
            raise IndexError(at)
        value = shift = 0
        for level, width in enumerate(self.widths):
            value |= int(self.section(f"codes{level}", _TYPES[width].str, at, 1)[0]) << shift
            shift += width
            if level + 1 == len(self.widths):
                break
            block, bit = divmod(at, BLOCK)
            n = min(BLOCK // 8, self.header["sections"][f"more{level}"][1] - block * (BLOCK // 8))
            bits = np.unpackbits(
                self.section(f"more{level}", "u1", block * (BLOCK // 8), n), bitorder="little"
            )
            if not bits[bit]:
                break
            at = int(self.section(f"ranks{level}", "<u4", block, 1)[0]) + int(bits[:bit].sum())
        return value

    def all(self) -> np.ndarray:
        """Every id in order."""
        total = self.header["tokens"]
        ids = np.zeros(total, np.uint32)
        at, shift = None, 0
        for level, width in enumerate(self.widths):
            codes = self.section(f"codes{level}", _TYPES[width].str).astype(np.uint32)
            if at is None:
                ids |= codes
            else:
                ids[at] |= codes << np.uint32(shift)
            shift += width
            if level + 1 == len(self.widths):
                break
            more = np.unpackbits(
                self.section(f"more{level}", "u1"), bitorder="little", count=len(codes)
            ).astype(bool)
            at = np.flatnonzero(more) if at is None else at[more]
        return ids


def _portions(texts: list[str], most: int = 6 << 20) -> Iterator[list[str]]:
    """``texts`` in runs of at most ``most`` characters, or one text."""
    first, size = 0, 0
    for at, text in enumerate(texts):
        if at > first and size + len(text) > most:
            yield texts[first:at]
            first, size = at, 0
        size += len(text)
    if texts:
        yield texts[first:]


MANIFEST = "part int, seq int, path string, docs bigint, tokens bigint"


def write(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    widths: Sequence[int] = (8, 8, 16),
    shard_tokens: int = 2_000_000,
    rows_per_task: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str | None = None,
) -> DataFrame:
    """Encode whole texts and write them as shards in ascending id order.

    Returns the manifest, a row per shard, itself a written table: ``part`` and
    ``seq`` give the order. Every document ends with ``end_id``; NULL text is
    empty; a NULL id comes first; rows with equal ids come in an arbitrary order
    among themselves. A shard is closed once it has ``shard_tokens``; a longer
    document makes a longer shard. No rows give no shard.

    Ranges of ids make the tasks. A task that is repeated writes files of new
    names, and only those of the attempt that counts are in the manifest.
    """
    spark = session_for(docs, 4096)
    folder = folder or shared_folder(spark, "ids")
    widths = tuple(widths)
    if sum(widths) != 32 or any(w not in _TYPES for w in widths):
        raise ValueError("widths must be 8, 16 or 32 bits and add up to 32")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        encoder = encoder_for(tokenizer)
        names, sizes, parts, held = [], [], [], 0
        made = []

        def close():
            nonlocal seq, held
            path = new_file(folder, f"{part:08d}-{seq:05d}", ".dac")
            ids = np.frombuffer(b"".join(parts), "<u4")
            write_file(path, shard_parts(names, np.cumsum(sizes), ids, widths))
            made.append((part, seq, path, len(names), len(ids)))
            seq, held = seq + 1, 0
            names.clear(), sizes.clear(), parts.clear()

        for batch in batches:
            ids = batch.column("id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            coded = chain.from_iterable(map(encoder.encode, _portions(texts)))
            for name, codes in zip(ids, coded, strict=True):
                names.append(name)
                sizes.append(len(codes) // 4 + 1)
                parts += [codes, end]
                held += sizes[-1]
                if held >= shard_tokens:
                    close()
        if names:
            close()
        columns = list(zip(*made, strict=True)) or [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["part", "seq", "path", "docs", "tokens"],
        )

    slim = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text")
    )
    tasks = max(1, -(-slim.select("id").count() // rows_per_task))
    # Rows of one id are spread by their text, so no id makes a large task.
    ranged = slim.repartitionByRange(tasks, "id", F.xxhash64("text")).sortWithinPartitions("id")
    return written(ranged.mapInArrow(run, MANIFEST), "manifest")


def starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``before``, the tokens of all shards before each.

    A row per shard, so the window is over tokens / shard_tokens rows.
    """
    order = Window.orderBy("part", "seq")
    return manifest.withColumn("before", F.sum("tokens").over(order) - F.col("tokens"))


def read(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """Documents from the shard files: ``id start n_tokens crc32`` and ``ids``.

    ``ids`` are little-endian unsigned 32-bit, end id included; ``crc32`` is
    theirs; ``start`` counts the ids of all documents before.
    """
    spark = session_for(manifest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(
                batch.column("path").to_pylist(), batch.column("before").to_pylist()
            ):
                shard = Shard(path)
                names, ends = shard.documents()
                ids = shard.all().astype("<u4", copy=False)
                shard.close()
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                ends = ends.astype(np.int64)
                view = memoryview(ids).cast("B")
                for at in range(0, len(names), 1000):
                    to = min(at + 1000, len(names))
                    spans = [view[4 * a : 4 * b] for a, b in zip(begins[at:to], ends[at:to])]
                    columns = [
                        pa.array(names[at:to], pa.int64()),
                        pa.array(begins[at:to] + before),
                        pa.array(ends[at:to] - begins[at:to]),
                        pa.array([zlib.crc32(s) for s in spans], pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.array([bytes(s) for s in spans], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=fields)

    fields = ["id", "start", "n_tokens", "crc32", *(["ids"] if with_ids else [])]
    kind = "id bigint, start bigint, n_tokens bigint, crc32 bigint" + ", ids binary" * with_ids
    listed = starts(manifest).select("path", "before")
    tasks = max(1, manifest.count())
    return listed.repartition(min(tasks, _slots(spark)), "path").mapInArrow(run, kind)


def _slots(spark: SparkSession) -> int:
    """Tasks for reading: several for each core, at least a few dozen."""
    return max(32, 4 * spark.sparkContext.defaultParallelism)


def crc_of(ids: Column) -> Column:
    return F.crc32(ids)
