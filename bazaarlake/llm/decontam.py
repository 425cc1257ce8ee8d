"""Benchmark decontamination by CGK embeddings and bit-sampling LSH.

Texts and items are sequences of normalised words. A window of a document, as
long as the item, is embedded by a random walk: at step j the symbol under the
pointer is put out, and the pointer moves on if a random function of (j, symbol)
says so. After a few steps the walks of two sequences that differ by an edit run
in step again, so a small edit distance becomes a small Hamming distance. Keys
made of the symbols at a few sampled steps are then equal with good probability,
and several walks and samples raise that to the wanted recall. Every pair of
equal keys is verified by the exact edit distance to the nearby text.

Before the walk, windows are left out that cannot be within the allowed edits
of any item of their length: an edit touches three word triples at most, so after t
edits at least L - 2 - 3 t of the window's triples are triples of the items. That
test loses nothing; it spares the walk for nearly all windows.

Items too short to allow edits are searched exactly, by hashes of their whole word
sequence. Characters of scripts without spaces are words of their own.

Items are taken in blocks of bounded size, one pass over the documents for each.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from bazaarlake.llm.common import binaries, free_name, session_for

#: Characters of scripts without spaces, and those scripts' marks.
_SOLID = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]"
)
_SOLID_MARKS = re.compile(
    "[\u3000-\u3004\u3008-\u3020\u3030\u303d-\u303f\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]"
)
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class Settings:
    """``share``: allowed edits per word. An item shorter than ``least`` words
    with edits cannot be told from chance; it is searched without.

    ``walks`` x ``samples`` keys of ``width`` symbols each: with a symbol equal
    with probability p, the recall is 1 - (1 - p ** width) ** (walks * samples).
    """

    share: float = 0.2
    least: int = 8
    walks: int = 6
    samples: int = 6
    width: int = 3
    seed: int = 11
    block_words: int = 400_000

    def edits(self, n: int) -> int:
        return int(math.floor(n * self.share + 1e-9))


def normal(word: bytes) -> bytes:
    """Lower case without marks at either end; may be empty."""
    return word.strip(MARKS).decode(errors="replace").lower().encode()


def raw_words(text: bytes) -> list[bytes]:
    """Split at ASCII space; characters of scripts without spaces stand alone."""
    if not text.isascii():
        plain = text.decode(errors="replace")
        if _SOLID.search(plain):
            text = _SOLID.sub(r" \g<0> ", _SOLID_MARKS.sub(" ", plain)).encode()
    return text.split()


def normal_words(text: bytes) -> list[bytes]:
    return [w for w in map(normal, raw_words(text)) if w]


def _mixed(columns: Iterable[np.ndarray]) -> np.ndarray:
    """Hash of a sequence of symbols, given as one array per place."""
    out = np.uint64(0)
    for column in columns:
        out = (out ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


_PLACES = 1 << 20


def _place(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Place of a triple of symbols in a table of bits; two triples may share one."""
    mixed = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
    mixed = mixed * np.uint64(0xC2B2AE3D27D4EB4F) + c.astype(np.uint64)
    return (mixed * np.uint64(0x165667B19E3779F9)) >> np.uint64(44)


def _begin_before(flags: np.ndarray, places: int) -> np.ndarray:
    """How many flagged triples begin before each of the places, and before the end."""
    known = np.zeros(places + 1, np.int32)
    np.cumsum(flags, out=known[1 : len(flags) + 1])
    known[len(flags) + 1 :] = known[len(flags)]
    return known


class _Codes(dict):
    """Raw word to symbol: 1.. for words of the items, 0 for others, -1 for none."""

    def __init__(self, vocabulary: dict[bytes, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> int:
        plain = normal(word)
        code = self.vocabulary.get(plain, 0) if plain else -1
        if len(self) < 1_000_000:
            self[word] = code
        return code


class Index:
    """Items of one block, with their keys; searches texts for them."""

    def __init__(self, items: Iterable[tuple[int, bytes]], settings: Settings):
        self.settings = settings
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], list]] = {}
        for name, text in items:
            got = normal_words(text)
            if not got:
                continue
            codes = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in got)
            by_length.setdefault(len(codes), {}).setdefault(codes, []).append(name)
        # Equal items share a number; a hit is reported for each of their names.
        self.groups = {
            n: (np.array(list(seqs), np.int32), list(seqs.values()))
            for n, seqs in sorted(by_length.items())
            if n >= settings.least
        }
        self.short = {n: seqs for n, seqs in sorted(by_length.items()) if n < settings.least}
        self.classes = self._classes()
        self.codes: _Codes | None = None
        self.keys: dict[int, list] = {}

    def _classes(self) -> list[list[int]]:
        """Lengths that share a first test: at most a tenth apart."""
        out: list[list[int]] = []
        for n in self.groups:
            if out and n <= out[-1][0] * 1.1:
                out[-1].append(n)
            else:
                out.append([n])
        return out

    def _prepare(self) -> None:
        """In the task: the random functions and the items' keys."""
        self.codes = _Codes(self.vocabulary)
        rng = np.random.default_rng(self.settings.seed)
        steps = 3 * max(self.groups, default=0)
        # 64 steps' bits of each symbol in one word.
        shape = (self.settings.walks, -(-steps // 64), len(self.vocabulary) + 2)
        self.bits = rng.integers(0, 2**64, shape, np.uint64)
        self.triples = np.zeros(_PLACES, np.uint64)
        for n, (items, _) in self.groups.items():
            at = _place(items[:, :-2], items[:, 1:-1], items[:, 2:]).ravel()
            self.triples[at] |= np.uint64(1 << (n % 64))
        self.samples, self.mixers = {}, rng.integers(1, 2**63, self.settings.width, np.uint64) | np.uint64(1)
        for n, (items, _) in self.groups.items():
            self.samples[n] = [
                [
                    np.sort(rng.choice(3 * n, self.settings.width, replace=False))
                    for _ in range(self.settings.samples)
                ]
                for _ in range(self.settings.walks)
            ]
            tables = []
            for keys in self._embed(items, n):
                order = np.argsort(keys, kind="stable")
                tables.append((keys[order], order))
            self.keys[n] = tables

    def _embed(self, rows: np.ndarray, n: int) -> Iterator[np.ndarray]:
        """Keys of the rows (symbol sequences of length n), table by table."""
        count = len(rows)
        past = len(self.vocabulary) + 1  # the symbol behind the end
        flat = np.concatenate([rows, np.full((count, 1), past, rows.dtype)], axis=1).ravel()
        start = np.arange(count) * (n + 1)
        for walk in range(self.settings.walks):
            sampled = self.samples[n][walk]
            wanted = sorted({int(j) for s in sampled for j in s})
            seen, at = {}, start.copy()
            for step in range(wanted[-1] + 1):
                symbol = flat[at]
                if step in wanted:
                    seen[step] = symbol
                bit = (self.bits[walk, step // 64][symbol] >> np.uint64(step % 64)) & np.uint64(1)
                at += bit.astype(np.int64) & (symbol != past)
            for sample in sampled:
                key = np.zeros(count, np.uint64)
                for j, mixer in zip(sample, self.mixers):
                    key = (key ^ (seen[int(j)].astype(np.uint64) + np.uint64(1))) * mixer
                    key ^= key >> np.uint64(29)
                yield key

    def _triples_left(self, n: int) -> int:
        return max(1, n - 2 - 3 * self.settings.edits(n))

    def _candidates(self, codes: np.ndarray, begins: np.ndarray, ends: np.ndarray):
        """(length, starts, item numbers) of windows that share a key with an item.

        ``codes``: all texts of a batch in a row; ``begins``, ``ends``: for each
        place the bounds of its text. Starts lie in the window's own text.
        """
        lengths_of = self._lengths_of(codes)
        places = np.arange(len(codes))
        for n in self.groups:
            here = (lengths_of >> np.uint64(n % 64)) & np.uint64(1)
            known = _begin_before(here, len(codes))
            stop = np.maximum(np.minimum(places + n, ends) - 2, places)
            at = places[known[stop] - known[:-1] >= self._triples_left(n)]
            if len(at):
                yield from self._equal_keys(codes, begins, ends, at, n)

    def _lengths_of(self, codes: np.ndarray) -> np.ndarray:
        """For each triple the lengths (bit n mod 64) of the items that have it."""
        return np.where(
            codes[:-2] > 0,
            self.triples[_place(codes[:-2], codes[1:-1], codes[2:])],
            np.uint64(0),
        )

    def _worth_it(self, codes: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Numbers of the texts that have a window with triples enough."""
        known = _begin_before(self._lengths_of(codes) != 0, len(codes))
        places = np.arange(len(codes))
        found = np.zeros(len(codes), bool)
        for lengths in self.classes:
            # Triples of a window begin before its last two words.
            stop = np.maximum(np.minimum(places + lengths[-1], ends) - 2, places)
            found |= known[stop] - known[:-1] >= min(map(self._triples_left, lengths))
        return np.unique(owner[found])

    def _equal_keys(self, codes, begins, ends, at, n):
        past = len(self.vocabulary) + 1
        for some in np.array_split(at, -(-len(at) // 20_000)):
            spans = some[:, None] + np.arange(n)
            inside = spans < ends[some][:, None]
            rows = np.where(inside, codes[np.minimum(spans, len(codes) - 1)], past)
            found = []
            for (keys, order), mine in zip(self.keys[n], self._embed(rows, n)):
                lo = np.searchsorted(keys, mine, "left")
                hi = np.searchsorted(keys, mine, "right")
                width = hi - lo
                hit = np.flatnonzero(width)
                if not len(hit):
                    continue
                rep = np.repeat(hit, width[hit])
                inner = np.arange(len(rep)) - np.repeat(np.cumsum(width[hit]) - width[hit], width[hit])
                item = order[lo[rep] + inner]
                # Neighbouring starts of one text are verified together.
                start = some[rep]
                start = start - (start - begins[start]) % max(1, n // 4)
                found.append(np.stack([item, start], axis=1))
            if found:
                pairs = np.unique(np.concatenate(found), axis=0)
                yield n, pairs[:, 1], pairs[:, 0]

    def _verify(self, codes, begins, ends, n, starts, items):
        """Least edits of each item to any stretch near its start, with the stretch."""
        most = self.settings.edits(n)
        reach = max(1, n // 4)
        seqs = self.groups[n][0][items]
        size = n + 2 * most + reach
        first = np.maximum(starts - most, begins[starts])
        spans = first[:, None] + np.arange(size)
        inside = spans < ends[starts][:, None]
        text = np.where(inside, codes[np.minimum(spans, len(codes) - 1)], -2)
        # With at most t edits, all but t words of the item occur in the stretch.
        there = (text[:, None, :] == seqs[:, :, None]).any(axis=2).sum(axis=1) >= n - most
        seqs, text, inside = seqs[there], text[there], inside[there]
        first, items = first[there], items[there]
        count = len(first)
        # Cells hold the cost above bit 20 and the place where the stretch began
        # below, so that a minimum takes both; the text's start is free.
        one = np.int64(1 << 20)
        steps = np.arange(size + 1, dtype=np.int64) * one
        cells = np.repeat(np.arange(size + 1, dtype=np.int64)[None, :], count, axis=0)
        for i in range(n):
            new = np.empty_like(cells)
            new[:, 0] = (i + 1) * one
            swap = cells[:, :-1] + (text != seqs[:, i : i + 1]) * one
            np.minimum(swap, cells[:, 1:] + one, out=new[:, 1:])
            cells = np.minimum.accumulate(new - steps, axis=1) + steps
        cells[:, 1:][~inside] = np.int64(1 << 50)
        last = cells.argmin(axis=1)
        best = cells[np.arange(count), last]
        edits, origin = best >> 20, best & (one - 1)
        keep = edits <= most
        return (
            (first + origin)[keep],
            (last - origin)[keep],
            items[keep],
            edits[keep],
        )

    def _exact(self, codes: np.ndarray, owner: np.ndarray, count: int) -> dict:
        """First place of each short item in each text: (0, place, words) by (text, item name)."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        begins = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=count))])
        for n, seqs in self.short.items():
            last = len(codes) - n + 1
            if last < 1:
                continue
            keys = _mixed(np.array(list(seqs), np.int32).T)
            mine = _mixed([codes[k : k + last] for k in range(n)])
            at = np.flatnonzero(np.isin(mine, keys) & (owner[:last] == owner[n - 1 :]))
            # Once per text and 64-bit key.
            pairs = np.stack([owner[at].astype(np.uint64), mine[at]], axis=1)
            at = at[np.unique(pairs, axis=0, return_index=True)[1]]
            for place in at.tolist():
                text = int(owner[place])
                for name in seqs.get(tuple(codes[place : place + n].tolist()), ()):
                    best[text, name] = (0, place - int(begins[text]), n)
        return best

    def _near(self, codes: np.ndarray, owner: np.ndarray, count: int, best: dict) -> None:
        """Adds to ``best`` what is found of the items that allow edits."""
        stops = np.cumsum(np.bincount(owner, minlength=count))
        texts_left = np.zeros(count, bool)
        texts_left[self._worth_it(codes, stops[owner], owner)] = True
        if not texts_left.any():
            return
        owner, codes = owner[texts_left[owner]], codes[texts_left[owner]]
        sizes = np.bincount(owner, minlength=count)
        stops = np.cumsum(sizes)
        ends, begins = stops[owner], (stops - sizes)[owner]
        for n, starts, items in self._candidates(codes, begins, ends):
            names = self.groups[n][1]
            for some in np.array_split(np.arange(len(starts)), -(-len(starts) // 1_000)):
                checked = self._verify(codes, begins, ends, n, starts[some], items[some])
                for at, length, item, edits in zip(*(x.tolist() for x in checked)):
                    text = int(owner[min(at, len(codes) - 1)])
                    found = (edits, at - int(stops[text] - sizes[text]), length)
                    for name in names[item]:
                        old = best.get((text, name))
                        if old is None or found < old:
                            best[text, name] = found

    def search(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(text number, item name, edits, first word, words), best per text and item.

        Words count from 0 over the text's normalised words.
        """
        if not self.groups and not self.short:
            return []
        if self.codes is None:
            self._prepare()
        lookup = self.codes.__getitem__
        lists = [list(map(lookup, raw_words(t))) for t in texts]
        sizes = np.array([len(x) for x in lists])
        codes = np.array([c for x in lists for c in x], np.int32)
        owner = np.repeat(np.arange(len(texts)), sizes)
        owner, codes = owner[codes >= 0], codes[codes >= 0]
        best = self._exact(codes, owner, len(texts))
        if self.groups and len(codes) >= 3:
            self._near(codes, owner, len(texts), best)
        return [(text, name, *found) for (text, name), found in sorted(best.items(), key=str)]


def blocks(items: DataFrame, settings: Settings, id_col: str, text_col: str) -> Iterator[Index]:
    """The items as indexes of at most ``block_words`` words (or one item)."""
    held: list[tuple[int, bytes]] = []
    words = 0
    rows = items.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    for row in rows.filter("text is not null").toLocalIterator():
        text = row["text"].encode()
        size = len(raw_words(text))
        if held and words + size > settings.block_words:
            yield Index(held, settings)
            held, words = [], 0
        held.append((row["id"], text))
        words += size
    if held:
        yield Index(held, settings)


HITS = "doc_id {id}, item_id {item}, edits int, first_word int, n_words int"


def find(
    docs: DataFrame,
    items: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """A row per document row and item found in it: edits, place and length in words.

    NULL and empty texts and items hold nothing. Repeated document rows are
    searched each; repeated items are reported by each id. No shuffle: documents
    are read once for each block of items.
    """
    session_for(docs)
    kinds = {
        "id": docs.schema[id_col].dataType.simpleString(),
        "item": items.schema[item_id].dataType.simpleString(),
    }
    schema = HITS.format(**kinds)
    item_type = to_arrow_type(items.schema[item_id].dataType)
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for index in blocks(items, settings, item_id, item_text):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = index.search(binaries(batch, "text"))
                if not hits:
                    continue
                rows = list(zip(*hits))
                target = [pa.array(rows[k], pa.int32()) for k in (2, 3, 4)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(rows[0])),
                        pa.array(rows[1], item_type),
                        *target,
                    ],
                    names=["doc_id", "item_id", "edits", "first_word", "n_words"],
                )

        out = out.unionByName(slim.mapInArrow(run, schema))
    return out


def _holds(index: Index):
    @F.arrow_udf("boolean")
    def hit(text: pa.Array) -> pa.Array:
        values = [t.encode() if t is not None else b"" for t in text.to_pylist()]
        found = {h[0] for h in index.search(values)}
        return pa.array([i in found for i in range(len(values))])

    return hit


def clean(
    docs: DataFrame,
    items: DataFrame,
    settings: Settings = Settings(),
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The document rows that hold no item, with all their columns, in one pass."""
    session_for(docs)
    name = free_name(docs.columns, "hit")
    out = docs
    for index in blocks(items, settings, item_id, item_text):
        out = out.withColumn(name, _holds(index)(F.col(f"`{text_col}`"))).filter(~F.col(name)).drop(name)
    return out
