"""Parts of many orders at once: how they travel to the state and how it stores them.

A lot is the orders that share LOTS-th of a hash. Its parts travel as one Arrow value a
task, and its state lies in pages: entries of a map that the hash chooses, of about PAGE
rows each. There are twice as many pages whenever they get too full, so that a change of
a few orders reads and writes a few pages of that size, however many orders there are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOTS = 1024
PAGE = 4096
# Rows that are packed at once, and rows of a lot that are worked on at once.
PACKED = 1 << 19
PIECE = 1 << 18

KINDS = ("order", "line", "payment")
AMOUNTS = ("value", "price", "freight")
#: What a task hands over; the stream's columns, with ``h`` = hash of the order.
ARRIVING = """order_id string, h bigint, kind tinyint, part int, value bigint, price bigint,
              freight bigint, file_time bigint, file_path string"""
PACK = "lot int, files array<struct<file_time bigint, file_path string>>, rows binary"

_ID = [pa.field("order_id", pa.string()), pa.field("h", pa.int64())]
_PART = [pa.field("kind", pa.int8()), pa.field("part", pa.int32())]
_PART += [pa.field(a, pa.int64()) for a in AMOUNTS]
ROWS = pa.schema([*_ID, *_PART, pa.field("file", pa.int32())])
_PACK = pa.schema(
    [
        pa.field("lot", pa.int32()),
        pa.field("files", pa.list_(pa.struct([("file_time", pa.int64()), ("file_path", pa.string())]))),
        pa.field("rows", pa.binary()),
    ]
)

# A page of parts: its records (an order and CHUNK part numbers in a row), and the parts
# of one record after the other.
CHUNK_BITS = 5
RECORDS = pa.schema([*_ID, pa.field("slot", pa.int32()), pa.field("n", pa.int32())])
PARTS = pa.schema(_PART)

# Threads cost more than they bring for values this small.
_PLAIN = pa.ipc.IpcWriteOptions(use_threads=False)
_SMALL = pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)
_READ = pa.ipc.IpcReadOptions(use_threads=False)


# ---- Arrow values ----


def to_bytes(batch: pa.RecordBatch, options: pa.ipc.IpcWriteOptions = _PLAIN) -> bytes:
    """The rows alone; whoever reads them knows the schema."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_bytes(value: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(pa.py_buffer(bytes(value)), options=_READ).read_next_batch()


def one_batch(table: pa.Table) -> pa.RecordBatch:
    """The rows of a table as one batch, also if there are none."""
    columns = [pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in table.columns]
    return pa.RecordBatch.from_arrays(columns, schema=table.schema)


def numbers(column: pa.Array) -> np.ndarray:
    """Whole numbers as they are, NULL as 0."""
    return column.fill_null(0).to_numpy(zero_copy_only=False)


def known(column: pa.Array) -> np.ndarray:
    return column.is_valid().to_numpy(zero_copy_only=False)


def spans(sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, begin, end) of each run of equal values."""
    if len(sorted_values):
        begins = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])
        ends = np.r_[begins[1:], len(sorted_values)]
        yield from zip(sorted_values[begins].tolist(), begins.tolist(), ends.tolist())


# ---- on the way ----


def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ARRIVING rows of a task to one PACK row a lot, for PACKED rows at a time."""
    files: dict[tuple[int, str], int] = {}
    held: list[pa.RecordBatch] = []

    def numbered(batch: pa.RecordBatch) -> pa.RecordBatch:
        """The file of each row by its number, as its path would be most of the row."""
        path = batch.column("file_path").dictionary_encode()
        place, time = path.indices.to_numpy(), batch.column("file_time").to_numpy()
        first = np.full(len(path.dictionary), len(place))
        np.minimum.at(first, place, np.arange(len(place)))
        names = zip(time[first].tolist(), path.dictionary.to_pylist())
        number = np.array([files.setdefault(name, len(files)) for name in names], "int32")
        file = number[place]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in ROWS.names[:-1]], pa.array(file)], schema=ROWS
        )

    def lots() -> pa.RecordBatch:
        rows = one_batch(pa.Table.from_batches(held, ROWS))
        lot = rows.column("h").to_numpy() & (LOTS - 1)
        order = np.argsort(lot.astype("int16"), kind="stable")
        rows, names = rows.take(pa.array(order)), list(files)
        file, out = rows.column("file").to_numpy(), []
        for number, begin, end in spans(lot[order]):
            used, place = np.unique(file[begin:end], return_inverse=True)
            part = rows.slice(begin, end - begin)
            part = part.set_column(len(ROWS) - 1, ROWS[-1], pa.array(place.astype("int32")))
            stamps = [dict(zip(("file_time", "file_path"), names[i])) for i in used]
            out.append({"lot": number, "files": stamps, "rows": to_bytes(part)})
        return pa.RecordBatch.from_pylist(out, schema=_PACK)

    for batch in batches:
        if batch.num_rows:
            held.append(numbered(batch))
        if sum(b.num_rows for b in held) >= PACKED:
            yield lots()
            files, held = {}, []
    if held:
        yield lots()


def unpacked(rows: Iterable) -> pa.Table:
    """The ROWS of PACK rows; ``file`` numbers all files from the first to the last."""
    lists, batches = [], []
    for row in rows:
        lists.append([(f["file_time"], f["file_path"]) for f in row["files"]])
        batches.append(from_bytes(row["rows"]))
    rank = {stamp: i for i, stamp in enumerate(sorted({s for stamps in lists for s in stamps}))}
    ranked = []
    for stamps, batch in zip(lists, batches):
        ranks = np.array([rank[s] for s in stamps], "int32")
        file = pa.array(ranks[batch.column("file").to_numpy()])
        ranked.append(batch.set_column(len(ROWS) - 1, ROWS[-1], file))
    return pa.Table.from_batches(ranked, ROWS)


def pieces(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """All rows of some orders at a time, about PIECE, each with pages of its own."""
    count = 1
    while rows.num_rows > count * PIECE:
        count *= 2
    if count == 1:
        yield one_batch(rows)
        return
    piece = page_of(numbers(one_batch(rows.select(["h"])).column(0)), 0, count)
    for number in range(count):
        some = rows.take(pa.array(np.flatnonzero(piece == number)))
        if some.num_rows:
            yield one_batch(some)


# ---- pages ----


def page_of(h: np.ndarray, slot: np.ndarray | int, count: int) -> np.ndarray:
    """Which of ``count`` pages (a power of two); a lot's own bits of the hash are left out."""
    return ((h >> 20) + np.asarray(slot, "int64") * 0x9E3779B1) & (count - 1)


def pages_for(rows: int, count: int) -> int:
    count = max(count, 1)
    while rows > count * PAGE:
        count *= 2
    return count


class Pages:
    """Tables of some schemas in the entries of a map state, spread over ``count`` pages."""

    def __init__(self, state, *schemas: pa.Schema):
        self.state, self.schemas = state, schemas

    def load(self, numbers: Iterable[int]) -> list[pa.RecordBatch]:
        found = [self.state.getValue((number,)) for number in numbers]
        return [
            one_batch(pa.Table.from_batches([from_bytes(values[i]) for values in found], schema))
            for i, schema in enumerate(self.schemas)
        ]

    def store(self, tables: Sequence[pa.RecordBatch], pages: Sequence[np.ndarray], numbers: Iterable[int]) -> None:
        """Writes the pages of ``numbers``; ``pages`` has the page of each table's rows."""
        cut = []
        for table, page in zip(tables, pages):
            order = np.argsort(page, kind="stable")
            cut.append((table.take(pa.array(order)), page[order]))
        for number in numbers:
            values = []
            for table, page in cut:
                begin, end = np.searchsorted(page, [number, number + 1])
                values.append(to_bytes(table.slice(begin, end - begin), _SMALL))
            self.state.updateValue((number,), tuple(values))


def same(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> np.ndarray:
    """Whether all columns agree, row by row."""
    equal = np.ones(len(a[0]), bool)
    for x, y in zip(a, b):
        equal &= x == y
    return equal


def where_in(values: pa.Array, among: pa.Array) -> np.ndarray:
    """Place of each value in ``among``, -1 if it is not there."""
    return pc.index_in(values, value_set=among).fill_null(-1).to_numpy(zero_copy_only=False)
