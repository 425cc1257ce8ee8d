"""What several training-data operators share: words, Arrow batches, scratch tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.session import durable, tune

#: A word is a longest run of characters other than these six.
SPACES = " \t\n\x0b\x0c\r"
_BREAK = "[ \\x09-\\x0D]+"


def session_for(df: DataFrame, batch_rows: int = 500) -> SparkSession:
    """The frame's session, with Arrow batches small enough for long texts."""
    spark = tune(df.sparkSession)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    return spark


def words(text: Column | str) -> Column:
    """The text's words in order; an empty array for NULL."""
    text = F.col(text) if isinstance(text, str) else text
    parts = F.split(F.coalesce(text, F.lit("")), _BREAK, -1)
    return F.filter(parts, lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def size_of(df: DataFrame) -> int:
    return df.count()


def binaries(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes; NULL is empty."""
    column = batch.column(name)
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(
            pa.binary() if pa.types.is_string(column.type) else pa.large_binary()
        )
    return [v if v is not None else b"" for v in column.to_pylist()]


def free_name(taken: Sequence[str], wanted: str) -> str:
    """``wanted``, or that with underscores so that it clashes with no column."""
    low = {name.lower() for name in taken}
    while wanted.lower() in low:
        wanted = f"_{wanted}"
    return wanted


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the cluster's shared folder: lineage ends here."""
    return durable(df, label)


def arrow_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches without the empty ones."""
    return (b for b in batches if b.num_rows)
