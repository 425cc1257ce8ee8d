"""Language-model scores of whole documents, next to a unigram base.

1. Texts are split once: a chunk keeps its distinct words and its texts' words as places
   among them. Chunks of documents send their distinct words with training counts, packed and
   cut into hash ranges. A range adds up the counts of its words over all chunks
   and answers each chunk with the counts of its own words, in its own order. So
   every document's words meet their corpus counts, a word in every document is one
   entry per chunk, and no vocabulary is gathered anywhere.
2. The most frequent words become symbols of the network, in classes of like
   total frequency. Any other word is in one of a fixed number of open classes by
   its ending; within one, its probability is its smoothed share of the class.
3. The network is trained over all training documents in rounds: groups of chunks
   train from the same weights, and the weights are averaged, weighted by tokens.
   Chunks and groups follow from the documents alone, so scores do not depend on how
   the input is partitioned.
4. Each chunk is scored with its counts and the network.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm import gru
from bazaarlake.llm.chunks import TEXTS, chunked
from bazaarlake.llm.common import written

ADD = 0.1  # added to every count


@dataclass(frozen=True)
class Settings:
    """``head`` most frequent words get symbols; others fall in ``open_classes``."""

    head: int = 2000
    head_classes: int = 40
    open_classes: int = 48
    hidden: int = 16
    rounds: int = 3
    rate: float = 0.05
    lanes: int = 128  # documents trained on side by side
    score_lanes: int = 384
    range_words: int = 2_000_000
    task_bytes: int = 32 << 20  # texts that are trained on one after the other


def held_out(name) -> bool:
    """Documents not learned from: crc32 of the id as text ends in the digit 0."""
    return zlib.crc32(str(name).encode()) % 10 == 0


def _open_class(word: bytes, classes: int) -> int:
    return zlib.crc32(word[-3:]) % classes


def _deal(words: list[bytes], ranges: int) -> np.ndarray:
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    return (hashes % np.uint64(ranges)).astype(np.int64)


@dataclass
class Words:
    """A chunk's distinct lower-cased words; its texts' words as places among them."""

    distinct: list[bytes]
    places: np.ndarray
    cuts: np.ndarray  # text i has the places from cuts[i] to cuts[i + 1]

    def of(self, text: int) -> np.ndarray:
        return self.places[self.cuts[text] : self.cuts[text + 1]]

    def counts(self, texts: np.ndarray) -> np.ndarray:
        """How often each word is in those texts, given as a mask."""
        chosen = np.repeat(texts, np.diff(self.cuts))
        return np.bincount(self.places[chosen], minlength=len(self.distinct))

    def dealt(self, ranges: int) -> Iterator[tuple[int, np.ndarray]]:
        """Per range the places of its words, ascending by word."""
        part = _deal(self.distinct, ranges)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(ranges + 1))
        for p in np.flatnonzero(np.diff(cuts)).tolist():
            yield p, order[cuts[p] : cuts[p + 1]]


def _words(data: bytes, size: int, lengths: list[int]) -> Words:
    raw = pa.Codec("zstd").decompress(data, decompressed_size=size) if size else pa.py_buffer(b"")
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    texts = pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(starts), raw])
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = split.values.dictionary_encode()
    places, cuts = coded.indices.to_numpy(), split.offsets.to_numpy().astype(np.int64)
    distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
    if b"" in distinct:  # blanks at either end of a text
        empty = distinct.index(b"")
        kept = places != empty
        cuts = np.concatenate([[0], np.cumsum(kept)])[cuts]
        places = places[kept]
        places = places - (places > empty)
        del distinct[empty]
    return Words(distinct, places, cuts)


CODED = ["chunk", "words", "size", "places", "cuts"]


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``ids chunk words size places cuts``: the texts are split once, for all later passes."""
    codec = pa.Codec("zstd", compression_level=1)
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in TEXTS]
        for i, (chunk, data, size, lengths) in enumerate(zip(*columns)):
            words = _words(data, size, lengths)
            raw = b" ".join(words.distinct)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("ids").slice(i, 1),
                    pa.array([chunk], pa.int64()),
                    pa.array([codec.compress(raw, asbytes=True)], pa.binary()),
                    pa.array([len(raw)], pa.int64()),
                    pa.array([codec.compress(words.places.astype("<i4").tobytes(), asbytes=True)], pa.binary()),
                    pa.array([words.cuts.tolist()], pa.list_(pa.int64())),
                ],
                names=["ids", *CODED],
            )


def _rows(table) -> Iterator[tuple[int, list, Words]]:
    """(chunk, ids, words of its texts)."""
    codec = pa.Codec("zstd")
    columns = [table.column(c).to_pylist() for c in ("ids", *CODED)]
    for ids, chunk, data, size, packed, cuts in zip(*columns):
        raw = codec.decompress(data, decompressed_size=size, asbytes=True) if size else b""
        n = 4 * cuts[-1]
        places = codec.decompress(packed, decompressed_size=n, asbytes=True) if n else b""
        distinct = raw.split(b" ") if size else []
        yield chunk, ids, Words(distinct, np.frombuffer(places, "<i4"), np.array(cuts, np.int64))


def _learned(ids: list) -> np.ndarray:
    return np.array([not held_out(i) for i in ids], bool)


_SENT = "chunk bigint, part int, words binary, size bigint, counts binary"
_ANSWER = (
    "chunk bigint, part int, counts binary, types array<bigint>, tokens array<bigint>, "
    "top array<struct<word: binary, n: bigint>>"
)


def _send(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            for chunk, ids, words in _rows(batch):
                out: list[list] = [[], [], [], [], []]
                counts = words.counts(_learned(ids)).astype("<u4")
                for p, mine in words.dealt(ranges):
                    raw = b" ".join([words.distinct[i] for i in mine.tolist()])
                    row = (chunk, p, codec.compress(raw, asbytes=True), len(raw), counts[mine].tobytes())
                    for column, value in zip(out, row):
                        column.append(value)
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary()]
                names = ["chunk", "part", "words", "size", "counts"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names
                )

    return run


def _answer(head: int, classes: int):
    """Adds up a range's counts; the row of chunk -1 holds what the model needs."""

    def run(group: pa.Table) -> pa.Table:
        codec = pa.Codec("zstd")
        part = group.column("part")[0].as_py()
        chunks = group.column("chunk").to_pylist()
        sizes = group.column("size").to_pylist()
        coded, counts = [], []
        for data, size, n in zip(group.column("words"), sizes, group.column("counts").to_pylist()):
            raw = codec.decompress(data.as_buffer(), decompressed_size=size)
            starts = pa.py_buffer(np.array([0, size], np.int64))
            text = pa.Array.from_buffers(pa.large_string(), 1, [None, starts, raw])
            # Bytes from here on: only their order and equality count.
            coded.append(pc.split_pattern(text, " ").values.view(pa.large_binary()).dictionary_encode())
            counts.append(np.frombuffer(n, "<u4"))
        coded = pa.chunked_array(coded).unify_dictionaries()
        words = coded.chunk(0).dictionary
        places = [c.indices.to_numpy() for c in coded.chunks]
        total = np.zeros(len(words), np.int64)
        for at, n in zip(places, counts):
            total[at] += n  # a chunk has a word once
        out: list[list] = [[], [], [], [], [], []]
        for chunk, at in zip(chunks, places):
            row = (chunk, part, total[at].astype("<u8").tobytes(), None, None, None)
            for column, value in zip(out, row):
                column.append(value)
        seen = np.flatnonzero(total)
        learned = pa.table({"word": words.take(pa.array(seen)), "n": total[seen]})
        kinds = np.fromiter(
            (_open_class(w, classes) for w in learned.column("word").to_pylist()), np.int64, len(seen)
        )
        types = np.bincount(kinds, minlength=classes)
        tokens = np.zeros(classes, np.int64)
        np.add.at(tokens, kinds, total[seen])
        order = [("n", "descending"), ("word", "ascending")]
        top = learned.take(pc.select_k_unstable(learned, head, sort_keys=order)).to_pylist()
        row = (-1, part, None, types, tokens, top)
        for column, value in zip(out, row):
            column.append(value)
        kinds = [
            pa.int64(),
            pa.int32(),
            pa.binary(),
            pa.list_(pa.int64()),
            pa.list_(pa.int64()),
            pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])),
        ]
        names = ["chunk", "part", "counts", "types", "tokens", "top"]
        return pa.table({k: pa.array(v, t) for k, v, t in zip(names, out, kinds, strict=True)})

    return run


@dataclass
class Vocabulary:
    """Symbols: the head words by class, the end, then the open classes."""

    head: dict[bytes, int]
    end: int
    classes: np.ndarray
    words: np.ndarray
    class_bias: np.ndarray
    word_bias: np.ndarray
    open_types: np.ndarray
    open_tokens: np.ndarray
    types: int
    tokens: int
    ends: int

    def open_log10(self, kinds: np.ndarray, counts: np.ndarray) -> np.ndarray:
        whole = self.open_tokens[kinds] + ADD * (self.open_types[kinds] + 1)
        return np.log10((counts + ADD) / whole)


class Symbols(dict):
    """Word to symbol; remembers up to a million words."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary.head)
        self.first_open = vocabulary.end + 1
        self.open = len(vocabulary.open_types)

    def __missing__(self, word: bytes) -> int:
        symbol = self.first_open + _open_class(word, self.open)
        if len(self) < 1_000_000:
            self[word] = symbol
        return symbol


def _plan(answers: DataFrame, ends: int, s: Settings) -> Vocabulary:
    """The vocabulary, from one row per range and at most ``head`` words in all."""
    facts = answers.filter("chunk = -1")
    sums = facts.select(
        F.posexplode(F.arrays_zip("types", "tokens")).alias("k", "x")
    ).groupBy("k").agg(F.sum("x.types").alias("types"), F.sum("x.tokens").alias("tokens"))
    types, tokens = np.zeros(s.open_classes, np.int64), np.zeros(s.open_classes, np.int64)
    for row in sums.collect():  # open_classes rows
        types[row["k"]], tokens[row["k"]] = row["types"], row["tokens"]
    top = facts.select(F.explode("top").alias("t")).select("t.word", "t.n")
    top = top.orderBy(F.desc("n"), "word").limit(s.head).collect()
    all_types, all_tokens = int(types.sum()), int(tokens.sum())
    # Classes of like total root frequency: the most frequent words are in small ones.
    listed = [(bytes(r["word"]), r["n"]) for r in top]
    weight = np.cumsum([n**0.5 for _, n in listed])
    kind = (
        np.minimum((weight / weight[-1] * s.head_classes).astype(int), s.head_classes - 1)
        if listed
        else np.zeros(0, int)
    )
    used = np.unique(kind)
    kind = np.searchsorted(used, kind)
    n_head = len(used)
    end = len(listed)
    for word, n in listed:
        k = _open_class(word, s.open_classes)
        types[k] -= 1
        tokens[k] -= n
    # Classes: head, the end, the open ones.
    classes = np.concatenate([kind, np.arange(n_head, n_head + 1 + s.open_classes)]).astype(np.int64)
    words = np.concatenate([np.searchsorted(kind, np.arange(n_head + 1)), [end + 1]]).astype(np.int64)
    counts = np.array([n for _, n in listed] + [ends], float)
    by_class = np.bincount(kind, counts[:-1], n_head) if n_head else np.zeros(0)
    by_class = np.concatenate([by_class, [ends], tokens]) + 0.5
    return Vocabulary(
        head={w: i for i, (w, _) in enumerate(listed)},
        end=end,
        classes=classes,
        words=words,
        class_bias=np.log(by_class / by_class.sum()),
        word_bias=np.log(np.maximum(counts, 0.5)),
        open_types=types,
        open_tokens=tokens,
        types=all_types + (ends > 0),
        tokens=all_tokens + ends,
        ends=ends,
    )


def _sequences(words: Words, symbols: Symbols, end: int) -> list[np.ndarray]:
    """The symbols of each text and its end."""
    known = np.fromiter(map(symbols.__getitem__, words.distinct), np.int32, len(words.distinct))
    flat = np.insert(known[words.places], words.cuts[1:], end)
    cuts = (words.cuts + np.arange(len(words.cuts))).tolist()
    return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


def _train(chunks: DataFrame, vocabulary: Vocabulary, s: Settings) -> gru.Parameters:
    """Rounds of local training; each averages the weights of all its tasks."""
    n_symbols = vocabulary.end + 1 + s.open_classes
    weights = gru.start(n_symbols, s.hidden, vocabulary.class_bias, vocabulary.word_bias)
    squares = {k: np.full_like(v, 1e-5) for k, v in weights.items()}
    groups = max(1, math.isqrt(chunks.select(F.shiftright("chunk", 32)).distinct().count()))

    def one(round_: int, weights, squares):
        def run(group: pa.Table) -> pa.Table:
            mine = {k: v.copy() for k, v in weights.items()}
            sums = {k: v.copy() for k, v in squares.items()}
            network = gru.Network(mine, vocabulary.classes, vocabulary.words)
            symbols, seen = Symbols(vocabulary), 0
            task = group.column("task")[0].as_py()
            for _, ids, words in _rows(group.sort_by("chunk")):
                docs = _sequences(words, symbols, vocabulary.end)
                docs = [docs[i] for i in np.flatnonzero(_learned(ids)).tolist()]
                if docs:
                    network.train(docs, sums, s.rate, s.lanes)
                    seen += sum(map(len, docs))
            names = [f"{kind}{k}" for kind in "ws" for k in mine] if seen else []
            data = [
                (v.astype(np.float64) * seen).astype("<f4").tobytes()
                for v in (*mine.values(), *sums.values())
            ]
            return pa.table(
                {
                    "g": pa.array([task % groups] * len(names), pa.int64()),
                    "name": pa.array(names, pa.string()),
                    "tokens": pa.array([seen] * len(names), pa.int64()),
                    "data": pa.array(data[: len(names)], pa.binary()),
                }
            )

        schema = "name string, tokens bigint, data binary"

        def add(group: pa.Table) -> pa.Table:
            total = None
            for data in group.column("data"):
                values = np.frombuffer(data.as_buffer(), "<f4").astype(np.float64)
                total = values if total is None else total + values
            tokens = sum(group.column("tokens").to_pylist())
            return pa.table(
                {
                    "name": group.column("name").slice(0, 1),
                    "tokens": pa.array([tokens]),
                    "data": pa.array([total.astype("<f4").tobytes()], pa.binary()),
                }
            )

        part = chunks.filter(F.pmod(F.shiftright("chunk", 32) + F.col("chunk"), F.lit(s.rounds)) == round_)
        tasks = part.select("ids", *CODED, F.shiftright("chunk", 32).alias("task")).groupBy("task")
        # Partial sums first: as many groups as the square root of the tasks, of like size.
        some = tasks.applyInArrow(run, f"g bigint, {schema}")

        def partial(group: pa.Table) -> pa.Table:
            return add(group.select(["name", "tokens", "data"]))

        return some.groupBy("name", "g").applyInArrow(partial, schema).groupBy("name").applyInArrow(
            add, schema
        )

    for round_ in range(s.rounds):
        rows = one(round_, weights, squares).collect()  # a dozen rows: the parameters
        for row in rows:
            into = weights if row["name"][0] == "w" else squares
            name = row["name"][1:]
            mean = np.frombuffer(row["data"], "<f4").astype(np.float64) / row["tokens"]
            into[name] = mean.astype(np.float32).reshape(into[name].shape)
    return weights


def scores(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id held_out n_tokens n_known train_tokens base_score score`` per document row.

    Whole texts are learned from and scored; NULL text is empty and scores its end
    alone. A NULL id counts as the text "None" where held-out is decided. Repeated
    rows are documents of their own. Without training documents every score is the
    smoothed one. Logarithms are to base 10.
    """
    s = settings
    id_type = docs.schema[id_col].dataType.simpleString()
    chunks = chunked(docs, id_col, text_col, s.task_bytes)
    size = chunks.agg(F.sum("size")).first()[0] or 0
    ranges = min(max(8, -(-size // (6 * s.range_words))), 1 << 20)
    coded = written(
        chunks.select("ids", *TEXTS).mapInArrow(
            _code,
            f"ids array<{id_type}>, chunk bigint, words binary, size bigint, places binary, cuts array<bigint>",
        ),
        "coded",
    )
    sent = coded.mapInArrow(_send(ranges), _SENT)
    answers = written(
        sent.groupBy("part").applyInArrow(_answer(s.head, s.open_classes), _ANSWER), "counts"
    )
    kept = F.coalesce(F.col("id").cast("string"), F.lit("None"))
    ends = (
        chunks.select(F.explode("ids").alias("id"))
        .filter(F.pmod(F.crc32(kept.cast("binary")), F.lit(10)) != 0)
        .count()
    )
    vocabulary = _plan(answers, ends, s)
    weights = _train(coded, vocabulary, s)

    def score(mine: pa.Table, told: pa.Table) -> pa.Table:
        _, ids, words = next(_rows(mine))
        counts = dict(zip(told.column("part").to_pylist(), told.column("counts").to_pylist()))
        known = np.zeros(len(words.distinct))
        for p, places in words.dealt(ranges):
            known[places] = np.frombuffer(counts[p], "<u8")
        symbols = Symbols(vocabulary)
        network = gru.Network(weights, vocabulary.classes, vocabulary.words)
        sequences = _sequences(words, symbols, vocabulary.end)
        total = network.score(sequences, s.score_lanes) / np.log(10)
        whole = vocabulary.tokens + ADD * (vocabulary.types + 1)
        base = np.log10((known + ADD) / whole)
        base_end = np.log10((vocabulary.ends + ADD) / whole)
        out: list[list] = [[], [], [], [], []]
        for i, model in enumerate(total.tolist()):
            at = words.of(i)
            c = known[at]
            kinds = sequences[i][:-1].astype(np.int64) - vocabulary.end - 1
            loose = kinds >= 0
            rest = vocabulary.open_log10(kinds[loose], c[loose]).sum()
            out[0].append(len(at) + 1)
            out[1].append(int((c > 0).sum()) + (vocabulary.ends > 0))
            out[2].append(float(np.append(base[at], base_end).sum()))
            out[3].append(model + float(rest))
            out[4].append(vocabulary.tokens)
        return pa.table(
            {
                "id": mine.column("ids").combine_chunks().flatten(),
                "held_out": pa.array([held_out(i) for i in ids]),
                "n_tokens": pa.array(out[0], pa.int64()),
                "n_known": pa.array(out[1], pa.int64()),
                "train_tokens": pa.array(out[4], pa.int64()),
                "base_score": pa.array(out[2], pa.float64()),
                "score": pa.array(out[3], pa.float64()),
            }
        )

    schema = (
        f"id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    told = answers.filter("chunk >= 0").select("chunk", "part", "counts")
    return (
        coded.groupBy("chunk")
        .cogroup(told.groupBy("chunk"))
        .applyInArrow(score, schema)
    )
