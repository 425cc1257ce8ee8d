"""Documents as compressed chunks: a row per run of documents, a table written once.

Operators whose tasks exchange what a whole run of documents needs work on these
rows: they are few, of bounded size unless one text is longer, and the same at
every read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import binaries, session_for, written

CHUNK_BYTES = 8 << 20  # a chunk is closed once its texts have so many
CHUNK_ROWS = 4096
TEXTS = ["chunk", "data", "size", "lengths"]


def chunked(
    docs: DataFrame, id_col: str, text_col: str, task_bytes: int | None = None
) -> DataFrame:
    """``chunk ids lengths size data``; NULL text is empty, NULL ids stay NULL.

    With ``task_bytes`` documents are first dealt by a hash of id and text to tasks of
    about so many bytes, so that chunks are the same however the input is laid out. The
    task is then ``chunk >> 32``.
    """
    spark = session_for(docs)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, seq = TaskContext.get().partitionId() << 32, 0
        ids: list = []
        texts: list[bytes] = []
        size = 0

        def close(kind: pa.DataType) -> pa.RecordBatch:
            nonlocal seq, size
            data = pa.Codec("zstd", compression_level=1).compress(b"".join(texts), asbytes=True)
            row = [
                pa.array([first + seq], pa.int64()),
                pa.array([list(ids)], pa.list_(kind)),
                pa.array([list(map(len, texts))], pa.list_(pa.int64())),
                pa.array([size], pa.int64()),
                pa.array([data], pa.binary()),
            ]
            seq, size = seq + 1, 0
            ids.clear(), texts.clear()
            names = ["chunk", "ids", "lengths", "size", "data"]
            return pa.RecordBatch.from_arrays(row, names=names)

        kind = None
        for batch in batches:
            kind = batch.column("id").type
            for one, text in zip(batch.column("id").to_pylist(), binaries(batch, "text")):
                ids.append(one)
                texts.append(text)
                size += len(text)
                if size >= CHUNK_BYTES or len(ids) >= CHUNK_ROWS:
                    yield close(kind)
        if ids:
            yield close(kind)

    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    if task_bytes:
        total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        deal = F.xxhash64("id", "text")
        tasks = max(1, -(-total // task_bytes))
        slim = slim.repartition(tasks, deal).sortWithinPartitions(deal, "id")
    schema = (
        f"chunk bigint, ids array<{id_type}>, lengths array<bigint>, size bigint, data binary"
    )
    out = written(slim.mapInArrow(run, schema), "chunks")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    return out


def split_texts(data: bytes, size: int, lengths: list[int]) -> Iterator[bytes]:
    """The texts of a chunk, one at a time."""
    raw = pa.Codec("zstd").decompress(data, decompressed_size=size, asbytes=True) if size else b""
    at = 0
    for n in lengths:
        yield raw[at : at + n]
        at += n


def texts_of(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, Iterator[bytes]]]:
    """(chunk, its texts) for each row."""
    columns = [table.column(c).to_pylist() for c in TEXTS]
    for chunk, data, size, lengths in zip(*columns):
        yield chunk, split_texts(data, size, lengths)
