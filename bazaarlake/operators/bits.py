"""A filter of keys of bounded size: a bit for each key, which others may share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of 64 bits: a table of about 6 MB at most, however many keys there are. More keys
# than bits let more rows through, no fewer.
WORDS = 2**19


def place(key: Column) -> tuple[Column, Column]:
    """(word, bit in it) of a key; NULL is a key."""
    at = F.pmod(F.xxhash64(key), F.lit(64 * WORDS))
    return F.shiftright(at, 6).cast("int"), (at % 64).cast("int")


def bits_of(keys: DataFrame, name: str) -> DataFrame:
    """``word bits``: the bits of all keys of column ``name``."""
    word, bit = place(F.col(name))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    return keys.groupBy(word.alias("word")).agg(F.bit_or(one).alias("bits"))


def sharing(rows: DataFrame, key: Column, bits: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose key has its bit set; ``left_anti``: the others.

    The bits are broadcast whatever Spark's limit, as their size is bounded.
    """
    word, bit = place(key)
    return rows.join(F.broadcast(bits), (word == bits["word"]) & (F.bit_get(bits["bits"], bit) == 1), how)
