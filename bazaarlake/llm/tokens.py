"""Token ids by the tokenizers library, each distinct word encoded once per worker.

A byte-level BPE never merges across the pieces its pattern cuts a text into, and
a single space before a non-space always starts a piece. So the ids of a text are
those of its space-separated units, and units repeat. Arrow cuts a batch into its
distinct units, the library encodes those not met before, and the ids of all texts
are gathered from them. Texts where that rule does not hold (runs of white space,
special tokens) are encoded whole, and so are all texts for a tokenizer of another
kind.
"""

from __future__ import annotations

import json
import os
import sys
import types
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
ROW = 20_000  # units encoded together


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder_for(path: str) -> Encoder:
    """The Python worker's encoder: tasks that share a worker share its units.

    This code reaches a worker by value, with globals of its own in every task; what
    tasks share is kept in a module that the worker makes.
    """
    shared = sys.modules.setdefault("bazaarlake_worker", types.ModuleType("bazaarlake_worker"))
    known = vars(shared).setdefault("encoders", {})
    if path not in known:
        known.clear()
        known[path] = Encoder(path)
    return known[path]


class Encoder:
    """Encodes whole texts; remembers at most about twice ``keep`` units."""

    def __init__(self, path: str, keep: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        spec = json.loads(self.lib.to_str())
        cut = spec.get("pre_tokenizer") or {}
        self.by_unit = (
            cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space", True)
            and spec.get("normalizer") is None
            and spec["model"]["type"] == "BPE"
            and not spec["model"].get("dropout")
        )
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.keep = keep
        self.units: dict[str, bytes] = {}
        self.old_units: dict[str, bytes] = {}
        self.lengths = self.byte_lengths() if self.by_unit else None

    def whole(self, text: str) -> bytes:
        ids = self.lib.encode(text, add_special_tokens=False).ids
        return np.array(ids, np.uint32).tobytes()

    def _learn(self, new: list[str]) -> None:
        """Units follow a space. One without ids needs its surroundings."""
        if len(self.units) + len(new) > self.keep:  # what is used again moves over
            self.old_units, self.units = self.units, {}
        units, old = self.units, self.old_units
        fresh = []
        for unit in new:
            if unit in old:
                units[unit] = old[unit]
            elif not unit or unit.strip() != unit:
                units[unit] = b""
            else:
                fresh.append(unit)
        for at in range(0, len(fresh), ROW):
            units.update(self._in_a_row(fresh[at : at + ROW]))

    def _in_a_row(self, some: list[str]) -> Iterable[tuple[str, bytes]]:
        """Each unit with its ids, none if it holds a special token. Units are encoded in
        a row, which costs the library far less, and cut apart by the bytes of their tokens."""
        row = " " + " ".join(some)
        if any(s in row for s in self.special):
            plain = [u for u in some if not any(s in u for s in self.special)]
            ids = dict.fromkeys(some, b"")
            if len(plain) == len(some):  # it lies across units
                ids.update((u, self.whole(" " + u)) for u in plain)
            elif plain:
                ids.update(self._in_a_row(plain))
            return ids.items()
        got = self.lib.encode_batch_fast([row], add_special_tokens=False)[0]
        ids = np.array(got.ids, np.uint32)
        token_ends = np.cumsum(self.lengths[ids])
        unit_ends = np.cumsum(pc.binary_length(pa.array(some)).to_numpy() + 1)
        cuts = np.searchsorted(token_ends, unit_ends)
        if not np.array_equal(token_ends[np.minimum(cuts, len(ids) - 1)], unit_ends):
            return ((unit, self.whole(" " + unit)) for unit in some)
        data, ends = ids.tobytes(), (4 * cuts + 4).tolist()
        return zip(some, map(data.__getitem__, map(slice, [0, *ends], ends)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if not texts:
            return []
        if not self.by_unit:
            got = self.lib.encode_batch(texts, add_special_tokens=False)
            return [np.array(g.ids, np.uint32).tobytes() for g in got]
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        begins = lists.offsets.to_numpy()[:-1].astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = coded.indices.to_numpy().astype(np.int64)
        units = [*map(self.units.get, distinct)]
        new = [u for u, known in zip(distinct, units) if known is None]
        if new:
            if len(self.units) + len(new) > self.keep:  # then all units of these texts are new
                new = distinct
            self._learn(new)
            units = [*map(self.units.get, distinct)]
        # The first unit of a text follows no space: it has codes of its own.
        firsts = [distinct[i] for i in at[begins].tolist()]
        got = self.lib.encode_batch_fast(firsts, add_special_tokens=False)
        codes = [*units, *(np.array(g.ids, np.uint32).tobytes() for g in got)]
        at[begins] = len(units) + np.arange(len(texts))
        sizes = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        loose = np.append(sizes[: len(units)] == 0, [f[-1:].isspace() for f in firsts])
        alone = np.logical_or.reduceat(loose[at], begins).tolist()
        flat = np.frombuffer(b"".join(codes), np.uint32)
        size = sizes[at]
        ends = np.cumsum(size)
        source = np.repeat((np.cumsum(sizes) - sizes)[at] - (ends - size), size)
        data = flat[source + np.arange(len(source))].tobytes()
        bounds = [*(4 * (ends - size)[begins]).tolist(), len(data)]
        return [
            self.whole(text) if odd or any(s in text for s in self.special) else data[a:b]
            for text, odd, a, b in zip(texts, alone, bounds, bounds[1:])
        ]

    def byte_lengths(self) -> np.ndarray:
        """UTF-8 bytes of each id's token, for byte-level vocabularies."""
        vocab = self.lib.get_vocab(with_added_tokens=True)
        sizes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, at in vocab.items():
            sizes[at] = len(token.encode()) if token in self.special else len(token)
        return sizes
