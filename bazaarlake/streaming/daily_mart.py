"""The daily mart from a stream of drops, with Spark's state store.

Orders, lines and payments of one order arrive in any order and any number of times.
The state of an order is its day, the parts it is made of and their sums. A part that
arrives changes the sums; what the order gave to its day is then taken back and what
it gives now is added. These signed rows, summed per day, are one change set of the
daily state (see ``plans.upkeep``). Nothing stored is read or rewritten.

- Late parts find their order in the state, however old its day is.
- Parts delivered again change nothing.
- The last file that has a part decides, as in the bronze stream.
- A batch that Spark repeats replaces its own change set.

The state store is asked for many orders at once (``OrderLots``): a call for each order
would be most of the time. ``OrderParts`` has the rule for one order. A hot order is many
records of CHUNK part numbers in a row, spread over many pages, never one large value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from bazaarlake.contracts import RAW
from bazaarlake.functions.dates import date_key, whole_years
from bazaarlake.functions.money import cents, round2
from bazaarlake.operators.cleaning import clean_order_items, clean_orders
from bazaarlake.plans import gold, upkeep
from bazaarlake.session import settings
from bazaarlake.sources.csv_drop import set_apart
from bazaarlake.sources.layers import Lake
from bazaarlake.streaming import lots
from bazaarlake.streaming.drops import FILE, read_drops

SUMS = ("lines", "value", "value_n", "price", "price_n", "freight", "freight_n", "paid", "paid_n")
# Sums that the amounts of a part go to.
SUMS_OF = {"line": ("value", "price", "freight"), "payment": ("paid",)}
HEAD = "known boolean, day int, " + ", ".join(f"{s} bigint" for s in SUMS)
PARTS = "parts array<struct<part int, value bigint, price bigint, freight bigint>>"
CHUNK = 1 << lots.CHUNK_BITS
OUT = "purchase_date_key int, " + ", ".join(f"{m} bigint" for m in upkeep.SALES)

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def figures(head: dict) -> dict:
    """What an order with a header and lines adds to its day, or many, in columns."""
    lines, paid = head["lines"], head["paid_n"] > 0  # every line repeats the order's payment
    return {
        "lines": lines,
        "orders": 1,
        "items": lines,
        "value": head["value"],
        "payment": paid * head["paid"] * lines,
        "price": head["price"],
        "freight": head["freight"],
        "value_n": head["value_n"],
        "payment_n": paid * lines,
        "price_n": head["price_n"],
        "freight_n": head["freight_n"],
    }


class OrderParts(StatefulProcessor):
    """Turns the parts of an order that arrive into changes of its day's sums."""

    def init(self, handle) -> None:
        self.head = handle.getValueState("head", HEAD)
        self.parts = handle.getMapState("parts", "kind string, chunk int", PARTS)

    @staticmethod
    def gives(head: dict) -> tuple | None:
        """What the order adds to its day; nothing before its header or first line came."""
        if not head["known"] or not head["lines"]:
            return None
        given = figures(head)
        return head["day"], tuple(given[m] for m in upkeep.SALES)

    @staticmethod
    def count(head: dict, kind: str, part: tuple, sign: int) -> None:
        if kind == "line":
            head["lines"] += sign
        for name, amount in zip(SUMS_OF[kind], part):
            if amount is not None:
                head[name] += sign * amount
                head[f"{name}_n"] += sign

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = self.head.get() if self.head.exists() else None  # without it there are no parts either
        names = ("known", "day", *SUMS)
        head = dict(zip(names, stored if stored else (False, None, *[0] * len(SUMS))))
        before, last, chunks, moved = self.gives(head), {}, {}, set()
        for row in rows:
            name, stamp = (row["kind"], row["part"]), (row["file_time"], row["file_path"])
            if name in last and last[name] > stamp:
                continue
            last[name] = stamp
            if row["kind"] == "order":
                head["known"], head["day"] = True, row["day"]
                continue
            now = (row["value"], row["price"], row["freight"])
            entry = (row["kind"], row["part"] // CHUNK)
            if entry not in chunks:
                found = self.parts.getValue(entry) if stored and self.parts.containsKey(entry) else None
                chunks[entry] = {p[0]: tuple(p[1:]) for p in found[0]} if found else {}
            was = chunks[entry].get(row["part"])
            if was != now:
                if was is not None:
                    self.count(head, row["kind"], was, -1)
                self.count(head, row["kind"], now, 1)
                chunks[entry][row["part"]] = now
                moved.add(entry)
        for entry in moved:
            self.parts.updateValue(entry, ([(part, *amounts) for part, amounts in chunks[entry].items()],))
        after = self.gives(head)
        self.head.update(tuple(head[n] for n in names))
        if before != after:
            for given, sign in ((before, -1), (after, 1)):
                if given is not None:
                    yield Row("purchase_date_key", *upkeep.SALES)(given[0], *[sign * f for f in given[1]])

    def close(self) -> None:
        pass


HEADS = pa.schema(
    [
        pa.field("order_id", pa.string()),
        pa.field("h", pa.int64()),
        pa.field("known", pa.bool_()),
        pa.field("day", pa.int32()),
        *[pa.field(s, pa.int64()) for s in SUMS],
    ]
)
DAYS = pa.schema(
    [pa.field("purchase_date_key", pa.int32()), *[pa.field(m, pa.int64()) for m in upkeep.SALES]]
)
NO_DAY = np.iinfo("int64").min
SIZES = "heads bigint, head_pages bigint, parts bigint, part_pages bigint"


class OrderLots(OrderParts):
    """``OrderParts`` for all orders of a lot at once; its changes are added up by day.

    Rows are ``lots.PACK`` rows, a result is the DAYS rows of the lot in one value.
    """

    def init(self, handle) -> None:
        self.sizes = handle.getValueState("sizes", SIZES)
        heads = handle.getMapState("heads", "page int", "rows binary")
        parts = handle.getMapState("parts", "page int", "records binary, parts binary")
        self.heads, self.parts = lots.Pages(heads, HEADS), lots.Pages(parts, lots.RECORDS, lots.PARTS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        sizes = list(self.sizes.get()) if self.sizes.exists() else [0] * 4
        before = list(sizes)
        changes = [self.change(piece, sizes) for piece in lots.pieces(lots.unpacked(rows))]
        if sizes != before:
            self.sizes.update(tuple(sizes))
        days = by_day(np.concatenate([d for d, _ in changes]), np.concatenate([f for _, f in changes]))
        if days.num_rows:
            yield Row("days")(lots.to_bytes(days))

    def change(self, rows: pa.RecordBatch, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Days and signed figures of the orders that ``rows`` change, which are then stored."""
        ids = rows.column("order_id").dictionary_encode()
        order, ids = ids.indices.to_numpy().astype("int64"), ids.dictionary
        h = np.empty(len(ids), "int64")
        h[order] = rows.column("h").to_numpy()
        kind, part = rows.column("kind").to_numpy(), rows.column("part").to_numpy()

        # Of each part the row of its last file.
        name = _name(order, kind, part)
        last = np.lexsort((rows.column("file").to_numpy(), name))
        last = last[np.append(name[last][1:] != name[last][:-1], True)]
        rows, name, order, kind = rows.take(pa.array(last)), name[last], order[last], kind[last]

        head, stored, place = self._heads_of(ids, h, sizes)
        before = {n: column.copy() for n, column in head.items()}
        header = kind == lots.KINDS.index("order")
        day = rows.column("value")
        head["known"][order[header]] = True
        head["day"][order[header]] = np.where(lots.known(day), lots.numbers(day), NO_DAY)[header]
        body = np.flatnonzero(~header)
        if len(body):
            self._take_parts(rows.take(pa.array(body)), name[body], order[body], ids, h, head, sizes)
        moved = (place < 0) | ~lots.same([*before.values()], [*head.values()])
        if moved.any():
            self._store_heads(ids, h, head, moved, stored, place, sizes)

        days, signed = [], []
        for of, sign in ((before, -1), (head, 1)):
            given = moved & of["known"] & (of["lines"] != 0)
            some = figures({n: column[given] for n, column in of.items()})
            days.append(of["day"][given])
            signed.append(
                sign * np.stack([np.broadcast_to(some[m], given.sum()) for m in upkeep.SALES], axis=1)
            )
        return np.concatenate(days), np.concatenate(signed)

    def _heads_of(
        self, ids: pa.Array, h: np.ndarray, sizes: list[int]
    ) -> tuple[dict[str, np.ndarray], pa.RecordBatch, np.ndarray]:
        """Columns of the orders' heads, all stored heads of their pages and their place there."""
        pages = np.unique(lots.page_of(h, 0, sizes[1])) if sizes[1] else []
        (stored,) = self.heads.load(pages)
        place = lots.where_in(ids, stored.column("order_id"))
        old, head = place >= 0, {}
        for name in ("known", "day", *SUMS):
            column = _filled(stored.column(name))
            head[name] = np.full(len(ids), NO_DAY if name == "day" else 0, column.dtype)
            head[name][old] = column[place[old]]
        return head, stored, place

    def _store_heads(
        self,
        ids: pa.Array,
        h: np.ndarray,
        head: dict[str, np.ndarray],
        moved: np.ndarray,
        stored: pa.RecordBatch,
        place: np.ndarray,
        sizes: list[int],
    ) -> None:
        old, new = place >= 0, place < 0
        count = lots.pages_for(sizes[0] + int(new.sum()), sizes[1])
        touched = np.unique(lots.page_of(h[moved], 0, count))
        tables = [stored]
        if count != sizes[1]:  # all pages are dealt anew
            read = np.unique(lots.page_of(h, 0, sizes[1])) if sizes[1] else []
            tables += self.heads.load(np.setdiff1d(np.arange(sizes[1]), read))
            touched = np.arange(count)
        columns = {}
        for name in ("known", "day", *SUMS):
            column = _filled(stored.column(name))
            column[place[old]] = head[name][old]
            columns[name] = [column, *[_filled(t.column(name)) for t in tables[1:]], head[name][new]]
        whole = {name: np.concatenate(column) for name, column in columns.items()}
        hashes = np.concatenate([*[t.column("h").to_numpy() for t in tables], h[new]])
        day = whole["day"]
        table = pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([*[t.column("order_id") for t in tables], ids.filter(pa.array(new))]),
                pa.array(hashes),
                pa.array(whole["known"]),
                pa.array(np.where(day == NO_DAY, 0, day), pa.int32(), mask=day == NO_DAY),
                *[pa.array(whole[s]) for s in SUMS],
            ],
            schema=HEADS,
        )
        self.heads.store([table], [lots.page_of(hashes, 0, count)], touched.tolist())
        sizes[:2] = sizes[0] + int(new.sum()), count

    def _take_parts(
        self,
        rows: pa.RecordBatch,
        name: np.ndarray,
        order: np.ndarray,
        ids: pa.Array,
        h: np.ndarray,
        head: dict[str, np.ndarray],
        sizes: list[int],
    ) -> None:
        """Stores lines and payments and counts them in the heads, those they replace with a minus."""
        slot = _slot(rows.column("part").to_numpy())
        read = np.unique(lots.page_of(h[order], slot, sizes[3])) if sizes[3] else np.empty(0, "int64")
        records, parts = self.parts.load(read)

        # The orders of the records get numbers behind those of the rows, unless they are the same.
        both = pa.concat_arrays([ids, records.column("order_id")]).dictionary_encode()
        at = both.indices.to_numpy()[len(ids) :].astype("int64")
        hashes = np.empty(len(both.dictionary), "int64")
        hashes[at] = records.column("h").to_numpy()
        hashes[: len(ids)] = h
        owner = np.repeat(at, records.column("n").to_numpy())
        names = np.concatenate([_name(owner, parts.column("kind").to_numpy(), parts.column("part").to_numpy()), name])
        after = np.argsort(names, kind="stable")
        again = names[after][1:] == names[after][:-1]
        was = np.full(len(name), -1)
        was[after[1:][again] - parts.num_rows] = after[:-1][again]

        kind = rows.column("kind").to_numpy()
        new = [rows.column(a) for a in lots.AMOUNTS]
        old = [parts.column(a).take(pa.array(np.maximum(was, 0), mask=was < 0)) for a in lots.AMOUNTS]
        new = [(lots.numbers(c), lots.known(c)) for c in new]
        old = [(lots.numbers(c), lots.known(c)) for c in old]
        moved = (was < 0) | ~lots.same([c for pair in new for c in pair], [c for pair in old for c in pair])
        for k, sums in SUMS_OF.items():
            here = moved & (kind == lots.KINDS.index(k))
            to = order[here]
            if k == "line":
                np.add.at(head["lines"], to, was[here] < 0)
            for s, (now, given), (then, taken) in zip(sums, new, old):
                np.add.at(head[s], to, now[here] - then[here])
                np.add.at(head[f"{s}_n"], to, given[here].astype("int64") - taken[here])
        if not moved.any():
            return

        kept = after[np.append(~again, True)]  # a row that came comes after the one it replaces
        whole = _one(parts, rows.select(lots.PARTS.names)).take(pa.array(kept))
        record = names[kept] >> _IN_RECORD
        begins = np.flatnonzero(np.append(True, record[1:] != record[:-1]))
        owner, slots = record[begins] >> _SLOTS, (record[begins] & ((1 << _SLOTS) - 1)) - _ZERO
        table = pa.RecordBatch.from_arrays(
            [
                both.dictionary.take(pa.array(owner)),
                pa.array(hashes[owner]),
                pa.array(slots.astype("int32")),
                pa.array(np.diff(np.append(begins, len(record))).astype("int32")),
            ],
            schema=lots.RECORDS,
        )
        total = sizes[2] + int((was < 0).sum())
        count = lots.pages_for(total, sizes[3])
        touched = np.unique(lots.page_of(h[order[moved]], slot[moved], count))
        if count != sizes[3]:
            rest, others = self.parts.load(np.setdiff1d(np.arange(sizes[3]), read))
            table, whole, touched = _one(table, rest), _one(whole, others), np.arange(count)
        page = lots.page_of(table.column("h").to_numpy(), table.column("slot").to_numpy(), count)
        self.parts.store(
            [table, whole], [page, np.repeat(page, table.column("n").to_numpy())], touched.tolist()
        )
        sizes[2:] = total, count


# A part's name in a lot is one number: its order's number, its slot (CHUNK numbers in a
# row), its kind and its place in the slot.
_IN_RECORD, _SLOTS = lots.CHUNK_BITS + 2, 32 - lots.CHUNK_BITS
_ZERO = 1 << (_SLOTS - 1)


def _slot(part: np.ndarray) -> np.ndarray:
    return part.astype("int64") >> lots.CHUNK_BITS


def _name(order: np.ndarray, kind: np.ndarray, part: np.ndarray) -> np.ndarray:
    record = (order << _SLOTS) | (_slot(part) + _ZERO)
    return (record << _IN_RECORD) | (kind.astype("int64") << lots.CHUNK_BITS) | (part & (CHUNK - 1))


def _filled(column: pa.Array) -> np.ndarray:
    """A column of a head that can be changed; a day that is NULL is NO_DAY."""
    if column.type == pa.int32():
        return np.where(lots.known(column), lots.numbers(column).astype("int64"), NO_DAY)
    return np.array(column.to_numpy(zero_copy_only=False))


def _one(a: pa.RecordBatch, b: pa.RecordBatch) -> pa.RecordBatch:
    return lots.one_batch(pa.Table.from_batches([a, b]))


def by_day(days: np.ndarray, signed: np.ndarray) -> pa.RecordBatch:
    """Signed figures added up, a row for each day."""
    found, place = np.unique(days, return_inverse=True)
    sums = np.zeros((len(found), signed.shape[1]), "int64")
    np.add.at(sums, place, signed)
    some = (sums != 0).any(axis=1)
    found, sums = found[some], sums[some]
    day = pa.array(np.where(found == NO_DAY, 0, found), pa.int32(), mask=found == NO_DAY)
    columns = [pa.array(np.ascontiguousarray(column)) for column in sums.T]
    return pa.RecordBatch.from_arrays([day, *columns], schema=DAYS)


def days_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """DAYS rows of the values that ``OrderLots`` gives."""
    for batch in batches:
        for value in batch.column("days"):
            yield lots.from_bytes(value.as_buffer())


def _part(rows: DataFrame, kind: str, part: Column, **values: Column) -> DataFrame:
    return rows.select(
        "order_id",
        F.xxhash64("order_id").alias("h"),
        F.lit(lots.KINDS.index(kind)).cast("tinyint").alias("kind"),
        part.cast("int").alias("part"),
        *[values.get(name, F.lit(None)).cast("bigint").alias(name) for name in lots.AMOUNTS],
        F.unix_micros(F.col(f"{FILE}.file_modification_time").cast("timestamp")).alias("file_time"),
        F.col(f"{FILE}.file_path").alias("file_path"),
    )


def order_parts(lake: Lake, folder: str, max_files: int | None = None) -> DataFrame:
    """Stream of the drops in ``folder/orders``, ``/order_items`` and ``/order_payments``.

    Rows are ``lots.ARRIVING``; the value of an order's header is its day.
    Rows without a complete key take no part; the bronze stream keeps them as rejects.
    """

    def drops(name: str) -> DataFrame:
        rows = read_drops(lake, f"{folder}/{name}", RAW[name], max_files)
        return set_apart(rows, RAW[name], keyed=True)[0]

    orders, items = clean_orders(drops("orders")), clean_order_items(drops("order_items"))
    price, freight = F.col("price"), F.col("freight_value")
    return (
        _part(orders, "order", F.lit(0), value=date_key(F.col("order_purchase_timestamp")))
        .unionByName(
            _part(
                items,
                "line",
                F.col("order_item_id"),
                value=cents(round2(price + freight)),
                price=cents(round2(price)),
                freight=cents(round2(freight)),
            )
        )
        .unionByName(
            _part(
                drops("order_payments"),
                "payment",
                F.col("payment_sequential"),
                value=cents(F.col("payment_value")),
            )
        )
    )


def start_daily_mart(
    lake: Lake, folder: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Carry all drops not seen before into the daily state, then stop.

    The number of state partitions is fixed by the first run's shuffle partitions.
    """
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    kept = upkeep.Upkeep(lake)

    def apply(batch: DataFrame, batch_id: int) -> None:
        days = batch.mapInArrow(days_of, OUT).groupBy("purchase_date_key").agg(
            *[F.sum(m).alias(m) for m in upkeep.SALES]
        )
        kept.add({"daily": days}, f"{stream}-{batch_id}")

    with settings(lake.spark, {STATE_STORE: ROCKSDB}):  # a started query keeps them
        return (
            order_parts(lake, folder, max_files)
            .mapInArrow(lots.packed, lots.PACK)
            .groupBy("lot")
            .transformWithState(OrderLots(), "days binary", outputMode="Update", timeMode="None")
            .writeStream.foreachBatch(apply)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def daily_mart(lake: Lake) -> DataFrame:
    """The mart as of the drops taken in so far, over whole calendar years."""
    state = upkeep.Upkeep(lake).state("daily")
    days = state.select(
        F.to_date(F.col("purchase_date_key").cast("string"), "yyyyMMdd").cast("timestamp_ntz").alias("day")
    )
    return upkeep.daily_mart(state, gold.dim_date(whole_years(days, "day")))
