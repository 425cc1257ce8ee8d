"""WARC archives with an index written first and reads of coalesced byte ranges.

Writing gives every record a gzip member of its own and notes file, offset, length,
URL and digest. Reading takes any selection of index rows, sorts them by place,
joins ranges that lie close together into one read and cuts the records out of it.
A payload that occurs more than once is stored once: the record with the largest
id is a response and the others are revisits of it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import binaries, same, session_for, written
from bazaarlake.llm.files import new_file, open_file, resolve, shared_folder

_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: URL name space
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
INDEX = (
    "id {id}, url string, record_type string, refers_to {id}, payload_bytes bigint, "
    "payload_digest string, file string, offset bigint, length bigint"
)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(name) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page:{name}')}>"


def _line(value: str) -> str:
    """A header value: no line breaks or other control characters."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(kind: str, name, url: str | None, payload: bytes, digest: str, refers_to, date: str):
    """One record; a revisit holds the HTTP head of its payload only."""
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head + payload if kind == "response" else head
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_urn(name)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_line(url) if url else f'urn:page:{name}'}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if name is not None:
        lines.append(f"Page-ID: {name}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
        if refers_to is not None:
            lines.append(f"Refers-To-Page-ID: {refers_to}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(raw: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in raw.decode().split("\r\n")[1:])
    return {p[0]: p[1] for p in pairs if len(p) == 2}


def parse(data: bytes) -> dict:
    """A record's fields and payload; checks lengths and the payload's digest."""
    head, rest = data.split(b"\r\n\r\n", 1)
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(_fields(http)["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (
        len(payload) != size or _digest(payload) != digest
    ):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    return {
        "id": fields.get("Page-ID"),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "refers_to": fields.get("Refers-To-Page-ID"),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def _member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write(
    pages: DataFrame,
    least: int = 0,
    archive_bytes: int = 64 << 20,
    level: int = 1,
    date: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    folder: str | None = None,
) -> DataFrame:
    """Write all pages; returns the index, a written table with a row per record.

    Payloads are the html as UTF-8, empty for NULL. Equal payloads of at least
    ``least`` bytes: every row with the largest id is a response, others are
    revisits; NULL ids are smallest. A NULL URL becomes ``urn:page:<id>``. No rows
    give an empty index. The ids are whole numbers.

    The largest id per digest is one row per digest, whatever the group's size;
    texts meet it by a join that Spark splits at a hot digest. Files have names
    that no other attempt uses; the index lists those of the attempt that counts.
    """
    spark = session_for(pages)
    folder = folder or shared_folder(spark, "warc")
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    id_type = pages.schema[id_col].dataType.simpleString()
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{url_col}`").alias("url"),
        html.alias("html"),
        F.sha1(html.cast("binary")).alias("digest"),
    )
    newest = written(
        rows.filter(F.octet_length("html") >= least)
        .groupBy(F.col("digest").alias("of"))
        .agg(F.max("id").alias("newest"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n"),
        "newest",
    )
    placed = rows.join(newest, F.col("digest") == F.col("of"), "left").select(
        "id",
        "url",
        "html",
        "newest",
        (F.col("of").isNull() | same(F.col("id"), F.col("newest"))).alias("first"),
    )
    arrow_id = pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, path, at = TaskContext.get().partitionId(), None, "", 0
        for batch in batches:
            made: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("id", "url", "newest", "first")]
            for payload, (name, url, newest, first) in zip(
                binaries(batch, "html"), zip(*columns), strict=True
            ):
                if out is None:
                    path, at = new_file(folder, f"{part:08d}", ".warc.gz"), 0
                    files, inner = resolve(path)
                    out = files.open_output_stream(inner, compression=None)
                kind = "response" if first else "revisit"
                refers = None if first else newest
                digest = _digest(payload)
                data = _member(record(kind, name, url, payload, digest, refers, date), level)
                out.write(data)
                made.append((name, url, kind, refers, len(payload), digest, path, at, len(data)))
                at += len(data)
                if at >= archive_bytes:
                    out.close()
                    out = None
            kinds = [arrow_id, pa.string(), pa.string(), arrow_id, pa.int64()]
            kinds += [pa.string(), pa.string(), pa.int64(), pa.int64()]
            if made:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*made), kinds, strict=True)], names=names
                )
        if out is not None:
            out.close()

    schema = INDEX.format(id="bigint")
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    index = written(placed.mapInArrow(run, schema), "index")
    return index.withColumns({c: F.col(c).cast(id_type) for c in ("id", "refers_to")})


def read(
    index: DataFrame,
    gap: int = 64 << 10,
    most: int = 8 << 20,
    slice_bytes: int = 16 << 20,
    with_payload: bool = True,
) -> DataFrame:
    """The records of the index rows: ids, types, digests and (responses) payloads.

    Rows are dealt out by file and slice of the file and sorted by offset. Ranges
    less than ``gap`` bytes apart are read at once, up to ``most`` bytes; a longer
    record is one read. Revisits tell the length and digest of the full payload.
    """
    session_for(index)
    schema = (
        "id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
        "payload_digest string" + ", payload string" * with_payload
    )

    def ranges(batches) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        path, held, end = None, [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("file", "offset", "length")]
            for file, offset, length in zip(*columns):
                far = held and (offset - end > gap or offset + length - held[0][0] > most)
                if file != path or far:
                    if held:
                        yield path, held
                    path, held, end = file, [], 0
                held.append((offset, length))
                end = max(end, offset + length)
        if held:
            yield path, held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, held in ranges(batches):
            first = held[0][0]
            with open_file(path) as file:
                data = file.read_at(max(o + n for o, n in held) - first, first)
            got = [parse(zlib.decompress(data[o - first : o - first + n], 31)) for o, n in held]
            whole = lambda key: [None if g[key] is None else int(g[key]) for g in got]
            columns = [
                pa.array(whole("id"), pa.int64()),
                pa.array([g["url"] for g in got], pa.string()),
                pa.array([g["record_type"] for g in got], pa.string()),
                pa.array(whole("refers_to"), pa.int64()),
                pa.array([g["payload_bytes"] for g in got], pa.int64()),
                pa.array([g["payload_digest"] for g in got], pa.string()),
            ]
            names = ["id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
            if with_payload:
                texts = [None if g["payload"] is None else g["payload"].decode() for g in got]
                columns.append(pa.array(texts, pa.string()))
                names.append("payload")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    places = index.select(
        "file", "offset", "length", F.floor(F.col("offset") / slice_bytes).alias("slice")
    )
    # Index rows are small, what they stand for is not: tasks by the archives' bytes.
    size = index.agg(F.sum("length")).first()[0] or 0
    return (
        places.repartition(max(1, -(-size // slice_bytes)), "file", "slice")
        .sortWithinPartitions("file", "offset")
        .select("file", "offset", "length")
        .mapInArrow(run, schema)
    )
