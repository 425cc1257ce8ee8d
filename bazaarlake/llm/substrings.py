"""Exact repeated passages by fixed-block anchors.

A window is ``window`` consecutive words; it is repeated if its words also start
anywhere else. Blocks of half a window, at multiples of their own length, are the
reference: every window holds a whole block of its own text, so of two equal
windows each meets a block of the other with one of its rolling hashes.

1. Documents are written once as chunks, a row each: ids, lengths and the
   compressed texts of a run of documents.
2. Anchors. Each chunk sends its distinct rolling block hashes, packed and cut into
   hash ranges, with two bits: stands at a block's place, occurs more than once. A
   range returns to each chunk the hashes that are a block somewhere and occur at
   least twice anywhere.
3. Extension. Where a chunk's anchors hit, the windows around them are candidates.
   Their 128-bit hashes go the same way, and those that occur twice are repeated.
   Overlapping ones make up the maximal repeats.
4. The words those cover are left out.

A passage that a third of all documents share is one entry per chunk in its hash
range, not one per document, and no pairs of places are ever made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.chunks import TEXTS, chunked, texts_of
from bazaarlake.llm.common import written

RANGE_WINDOWS = 4_000_000  # hashes that one range is sized for
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class _Hashes(dict):
    """64-bit hash of a word; remembers up to a million words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < 1_000_000:
            self[word] = value
        return value


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Roller:
    """Hashes of all runs of consecutive words, for several lengths."""

    def __init__(self) -> None:
        self.cache = _Hashes()
        self.powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def words(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.cache.__getitem__, tokens), np.uint64, len(tokens))

    def runs(self, hashes: np.ndarray, length: int, which: int = 0) -> np.ndarray:
        """Hash of hashes[i:i + length] for every i that has so many."""
        n = len(hashes)
        if n < length:
            return np.empty(0, np.uint64)
        known = self.powers.get(which)
        if known is None or len(known[0]) < n:
            known = self.powers[which] = _powers(_MULTIPLIERS[which], max(2 * n, 4096))
        up, down = known
        if which:  # an independent hash of the words
            hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            hashes ^= hashes >> np.uint64(29)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * up[:n], out=sums[1:])
        runs = (sums[length:] - sums[:-length]) * down[: n - length + 1]
        return _mix(runs)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


# Entries travel as the low five bytes: 38 bits of the hash above the two flags.
_BLOCK, _AGAIN = np.uint64(1), np.uint64(2)
_LOW = np.uint64((1 << 40) - 4)


def _five(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_five(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view("<u8").ravel()


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Ranges by the top bits, which the entries leave out."""
    return ((hashes >> np.uint64(40)) * np.uint64(ranges)) >> np.uint64(24)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the flags of all that share a value, plus 'again'."""
    order = np.argsort(values & _LOW, kind="stable")
    sorted_ = values[order]
    keys = sorted_ & _LOW
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(first)
    flags = np.bitwise_or.reduceat(sorted_ & np.uint64(3), at)
    flags |= np.where(np.diff(np.append(at, len(keys))) > 1, _AGAIN, np.uint64(0))
    return keys[at], flags


_PACKED = "chunk bigint, part int, data binary"
_ANSWER = "chunk bigint, part int, data binary"


def _packed(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    chunk, part, data = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk, pa.int64()), pa.array(part, pa.int32()), pa.array(data, pa.binary())],
        names=["chunk", "part", "data"],
    )


def _anchors(chunks: DataFrame, block: int, ranges: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for chunk, some in (x for batch in batches for x in texts_of(batch)):
            entries = []
            for text in some:
                runs = roller.runs(roller.words(text.split()), block)
                if len(runs):
                    flagged = runs & ~np.uint64(3)
                    flagged[::block] |= _BLOCK
                    entries.append(flagged)
            if not entries:
                continue
            values = np.concatenate(entries)
            # Top bits first: equal ranges are neighbours after one sort.
            values.sort()
            part = _range_of(values, ranges)
            cuts = np.searchsorted(part, np.arange(ranges + 1))
            rows = []
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                keys, flags = _distinct(values[cuts[p] : cuts[p + 1]])
                rows.append((chunk, p, _five(keys | flags)))
            yield _packed(rows)

    return chunks.select(*TEXTS).mapInArrow(run, _PACKED)


def _meet_anchors(group: pa.Table) -> pa.Table:
    """Per chunk its hashes that are a block somewhere and occur twice anywhere."""
    chunks = group.column("chunk").to_pylist()
    lists = [_from_five(d) for d in group.column("data").to_pylist()]
    keys, flags = _distinct(np.concatenate(lists))
    hot = keys[flags == np.uint64(3)]
    rows = []
    part = group.column("part")[0].as_py()
    for chunk, values in zip(chunks, lists):
        mine = values & _LOW
        at = np.minimum(np.searchsorted(hot, mine), max(len(hot) - 1, 0))
        hit = mine[hot[at] == mine] if len(hot) else mine[:0]
        if len(hit):
            rows.append((chunk, part, _five(hit)))
    return pa.Table.from_batches([_packed(rows)])


def _full(part: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (part.astype(np.uint64) << np.uint64(40)) | low


def _hits_of(answer: pa.Table) -> np.ndarray:
    """(range << 40 | low bits), sorted."""
    out = []
    for part, data in zip(answer.column("part").to_pylist(), answer.column("data").to_pylist()):
        out.append(_full(np.array(part), _from_five(data)))
    return np.sort(np.concatenate(out)) if out else np.empty(0, np.uint64)


def _located(runs: np.ndarray, ranges: int) -> np.ndarray:
    return _full(_range_of(runs, ranges), runs & _LOW)


def _candidates(roller, tokens, block, window, hits, ranges):
    """Starts of candidate windows with both their hashes."""
    words = roller.words(tokens)
    n = len(words) - window + 1
    none = np.empty(0, np.int64)
    if n <= 0 or not len(hits):
        return none, none.astype(np.uint64), none.astype(np.uint64)
    mine = _located(roller.runs(words, block), ranges)
    at = np.minimum(np.searchsorted(hits, mine), len(hits) - 1)
    hit = np.concatenate([[0], np.cumsum(hits[at] == mine)])
    starts = np.arange(n)
    starts = starts[hit[starts + window - block + 1] > hit[starts]]
    return starts, roller.runs(words, window)[starts], roller.runs(words, window, 1)[starts]


def _pairs(a, b) -> np.ndarray:
    out = np.empty(len(a), dtype=[("a", "<u8"), ("b", "<u8")])
    out["a"], out["b"] = a, b
    return out


def repeats(
    docs: DataFrame,
    window: int = 35,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document row ``id n_words n_removed kept_sha256``, ``kept`` and ``spans``.

    ``spans`` are the maximal repeats as [first, end) in words; ``kept`` is what is
    left, joined by single spaces. Whole texts are read; NULL has no words. Windows
    are judged on the input. A text with fewer words than a window keeps them all.
    Repeated rows and ids are texts of their own (and so repeats). No rows give none.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    block = (window + 1) // 2
    chunks = chunked(docs, id_col, text_col)
    size = chunks.agg(F.sum("size")).first()[0] or 0
    ranges = -(-size // (6 * RANGE_WINDOWS))  # about six bytes a word
    ranges = min(max(ranges, 8), 1 << 23)
    anchors = written(
        _anchors(chunks, block, ranges).groupBy("part").applyInArrow(_meet_anchors, _ANSWER),
        "anchors",
    )

    def windows(mine: pa.Table, hits_: pa.Table) -> pa.Table:
        """Candidate windows of a chunk: distinct pairs of hashes, with a flag."""
        hits = _hits_of(hits_)
        roller, found = Roller(), []
        chunk, texts = next(texts_of(mine), (0, ()))
        for text in texts if len(hits) else ():
            _, a, b = _candidates(roller, text.split(), block, window, hits, ranges)
            if len(a):
                found.append(_pairs(a, b))
        if not found:
            return pa.Table.from_batches([_packed([])])
        values, _, n = _grouped(np.concatenate(found))
        part = _range_of(values["a"], ranges)
        cuts = np.searchsorted(part, np.arange(ranges + 1))
        rows = []
        for p in np.flatnonzero(np.diff(cuts)).tolist():
            some = slice(cuts[p], cuts[p + 1])
            again = np.packbits(n[some] > 1).tobytes()
            rows.append((chunk, p, values[some].tobytes() + again))
        return pa.Table.from_batches([_packed(rows)])

    grouped = chunks.select(*TEXTS).groupBy("chunk")
    near = grouped.cogroup(anchors.groupBy("chunk")).applyInArrow(windows, _PACKED)
    confirmed = written(
        near.groupBy("part").applyInArrow(_meet_windows, _ANSWER), "windows"
    )

    def cut(mine: pa.Table, hits_: pa.Table) -> pa.Table:
        lists = [np.frombuffer(d, _pairs([], []).dtype) for d in hits_.column("data").to_pylist()]
        hits = _grouped(np.concatenate(lists))[0] if lists else _pairs([], [])
        firsts, seconds = np.ascontiguousarray(hits["a"]), np.ascontiguousarray(hits["b"])
        roller = Roller()
        out: list[list] = [[], [], [], [], []]
        for text in next(texts_of(mine))[1]:
            tokens = text.split()
            spans = _spans(roller, tokens, window, firsts, seconds)
            kept, at = [], 0
            for first, end in spans:
                kept += tokens[at:first]
                at = end
            kept += tokens[at:]
            left = b" ".join(kept)
            out[0].append(len(tokens))
            out[1].append(len(tokens) - len(kept))
            out[2].append(hashlib.sha256(left).hexdigest())
            out[3].append(left.decode())
            out[4].append([{"first": a, "end": b} for a, b in spans])
        kinds = [
            pa.int64(),
            pa.int64(),
            pa.string(),
            pa.string(),
            pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])),
        ]
        names = ["n_words", "n_removed", "kept_sha256", "kept", "spans"]
        return pa.table(
            {"id": mine.column("ids").combine_chunks().flatten()}
            | {k: pa.array(v, t) for k, v, t in zip(names, out, kinds, strict=True)}
        )

    schema = (
        f"id {id_type}, n_words bigint, n_removed bigint, kept_sha256 string, kept string, "
        "spans array<struct<first: int, end: int>>"
    )
    return (
        chunks.groupBy("chunk")
        .cogroup(confirmed.groupBy("chunk"))
        .applyInArrow(cut, schema)
    )


def _grouped(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, for each pair the number of its like, and their counts."""
    order = np.lexsort((pairs["b"], pairs["a"]))
    a, b = pairs["a"][order], pairs["b"][order]
    first = np.ones(len(pairs), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.empty(len(pairs), np.int64)
    at[order] = np.cumsum(first) - 1
    starts = np.flatnonzero(first)
    return pairs[order[starts]], at, np.diff(np.append(starts, len(pairs)))


def _meet_windows(group: pa.Table) -> pa.Table:
    """Per chunk its windows that occur twice anywhere."""
    kind = _pairs([], []).dtype
    chunks = group.column("chunk").to_pylist()
    lists, flags = [], []
    for data in group.column("data").to_pylist():
        n = (len(data) * 8) // (16 * 8 + 1)
        lists.append(np.frombuffer(data, kind, n))
        flags.append(
            np.unpackbits(np.frombuffer(data, np.uint8, offset=16 * n), count=n).astype(bool)
        )
    _, at, n = _grouped(np.concatenate(lists))
    twice = n > 1
    np.logical_or.at(twice, at[np.concatenate(flags)], True)
    rows, start = [], 0
    part = group.column("part")[0].as_py()
    for chunk, mine in zip(chunks, lists):
        keep = twice[at[start : start + len(mine)]]
        start += len(mine)
        if keep.any():
            rows.append((chunk, part, mine[keep].tobytes()))
    return pa.Table.from_batches([_packed(rows)])


def _spans(roller, tokens, window, firsts, seconds) -> list[tuple[int, int]]:
    """Maximal runs of words covered by confirmed windows; those sorted by both hashes."""
    if len(tokens) < window or not len(firsts):
        return []
    words = roller.words(tokens)
    a, b = roller.runs(words, window), roller.runs(words, window, 1)
    at = np.searchsorted(firsts, a)
    starts = np.flatnonzero(firsts[np.minimum(at, len(firsts) - 1)] == a)
    if not len(starts):
        return []
    a, b, at = a[starts], b[starts], at[starts]
    found = seconds[at] == b
    while True:  # the rare windows that share their first hash only
        at = np.minimum(at + 1, len(firsts) - 1)
        more = (firsts[at] == a) & (seconds[at] == b) & ~found
        found |= more
        if not ((firsts[at] == a) & ~found & (at < len(firsts) - 1)).any():
            break
    starts = starts[found]
    spans: list[tuple[int, int]] = []
    for s in starts.tolist():
        if spans and s <= spans[-1][1]:
            spans[-1] = (spans[-1][0], s + window)
        else:
            spans.append((s, s + window))
    return spans
