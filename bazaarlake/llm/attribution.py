"""Token counts of fields or sections, from one encoding of the whole document.

A text is encoded once. The spans of its tokens, joined by interval with the spans
of its sections, say how many tokens each section has; a token that crosses a
boundary is allocated by a rule:

``majority``  to the section with most of its bytes, the earlier one on a tie;
``start``     to the section with its first byte;
``split``     to every section by its share of the token's bytes.

Bytes of no section (line breaks between lines, say) count for no section; a token
or share without a section goes to section -1, so that the counts of a document
always add up to its tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import session_for
from bazaarlake.llm.tokens import Encoder, encoder_for

RULES = ("majority", "start", "split")
Spans = tuple[np.ndarray, np.ndarray]


def line_spans(data: bytes) -> Spans:
    """Byte spans of the lines, without their line feeds; an empty text has one."""
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    return np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(data)]])


def byte_offsets(data: bytes) -> np.ndarray:
    """Byte offset of every character, and of the end."""
    raw = np.frombuffer(data, np.uint8)
    return np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(data))


def allocate(tokens: Spans, sections: Spans, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Per section (the last entry: none) its tokens, and those that cross its bounds.

    Sections are disjoint, in order, and may be empty; tokens are in order.
    """
    (begin, end), (first, last) = tokens, sections
    n = len(first)
    low = np.searchsorted(last, begin, "right")  # sections that end after the token begins
    high = np.maximum(np.searchsorted(first, end, "left"), low)
    width = high - low
    token = np.repeat(np.arange(len(begin)), width)
    section = np.arange(len(token)) - np.repeat(np.cumsum(width) - width, width) + low[token]
    shared = np.minimum(end[token], last[section]) - np.maximum(begin[token], first[section])
    real = shared > 0
    token, section, shared = token[real], section[real], shared[real]
    size = np.maximum(end - begin, 1)
    crossing = np.bincount(section[shared < size[token]], minlength=n + 1)
    if rule == "split":
        counts = np.bincount(section, shared / size[token], n + 1)
        counts[n] = len(begin) - counts[:n].sum()
        return counts, crossing
    owner = np.full(len(begin), n)
    if rule == "start":
        at = first[section] <= begin[token]
        owner[token[at]] = section[at]
    else:
        order = np.lexsort((-section, shared, token))  # the winner comes last
        owner[token[order]] = section[order]
    return np.bincount(owner, minlength=n + 1).astype(float), crossing


def count(
    docs: DataFrame,
    tokenizer: str,
    sections: str | None = None,
    rule: str = "majority",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id section name first end tokens crossing``, a row per section of a document.

    ``sections`` names a column of array<struct<name: string, first: int, end: int>>:
    disjoint character spans in order; without it sections are the lines. ``first``
    and ``end`` are in bytes of the UTF-8 text. Section -1 has the tokens of no
    section and is left out if it has none.

    NULL text is empty; a NULL array or empty one gives section -1 alone (if the
    text has tokens); spans beyond the text are cut at its end. Repeated rows are
    counted each. No shuffle, a text in memory at a time beside its batch.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    session_for(docs, 4096)
    id_type = docs.schema[id_col].dataType.simpleString()
    picked = [F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")]
    if sections:
        picked.append(F.col(f"`{sections}`").alias("sections"))

    def spans_of(encoder: Encoder) -> Callable[[list[str]], Iterator[Spans]]:
        if encoder.by_unit:
            lengths = encoder.lengths

            def spans(texts):
                for codes in encoder.encode(texts):
                    sizes = lengths[np.frombuffer(codes, "<u4")]
                    ends = np.cumsum(sizes)
                    yield ends - sizes, ends
        else:

            def spans(texts):
                for text, got in zip(texts, encoder.lib.encode_batch(texts, add_special_tokens=False)):
                    at = byte_offsets(text.encode())
                    pairs = np.array(got.offsets, np.int64).reshape(-1, 2)
                    yield at[pairs[:, 0]], at[pairs[:, 1]]

        return spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = spans_of(encoder_for(tokenizer))
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            given = batch.column("sections").to_pylist() if sections else [None] * len(texts)
            out: list[list] = [[], [], [], [], [], []]
            rows, names = [], []
            for at, (text, tokens, listed) in enumerate(zip(texts, spans(texts), given)):
                data = text.encode()
                if sections:
                    offsets = byte_offsets(data)
                    cut = len(offsets) - 1
                    listed = listed or []
                    first = offsets[[min(max(x["first"], 0), cut) for x in listed]]
                    end = np.maximum(offsets[[min(max(x["end"], 0), cut) for x in listed]], first)
                    named = [x["name"] for x in listed]
                else:
                    first, end = line_spans(data)
                    named = [None] * len(first)
                counts, crossing = allocate(tokens, (first, end), rule)
                n = len(first) + (counts[-1] > 0)
                rows.append(np.full(n, at))
                names += [*named, None][:n]
                numbers = np.arange(len(first) + 1)
                numbers[-1] = -1
                for column, values in zip(
                    out, (numbers, np.append(first, 0), np.append(end, 0), counts, crossing)
                ):
                    column.append(values[:n])
            if not rows:
                continue
            numbers, first, end, counts, crossing = (np.concatenate(c) for c in out[:5])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(np.concatenate(rows))),
                    pa.array(numbers, pa.int32()),
                    pa.array(names, pa.string()),
                    pa.array(first, pa.int64()),
                    pa.array(end, pa.int64()),
                    pa.array(counts, pa.float64()),
                    pa.array(crossing, pa.int64()),
                ],
                names=["id", "section", "name", "first", "end", "tokens", "crossing"],
            )

    schema = (
        f"id {id_type}, section int, name string, first bigint, end bigint, tokens double, "
        "crossing bigint"
    )
    return docs.select(*picked).mapInArrow(run, schema)
