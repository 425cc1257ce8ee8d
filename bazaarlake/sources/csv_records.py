"""Large CSV files whose fields hold line breaks, read by many tasks.

Spark reads such a file in one task, as a line break tells nothing there. Here the file
is read as lines, which split; a line begins a record if an even number of quotes comes
before it in the file. Quotes are counted per block first, so only a row per block and
file meets in a window over the file; lines meet within their block. Lines of a record
are put together, across blocks too, and parsed by Spark's CSV functions.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlake.contracts import Contract
from bazaarlake.session import passing
from bazaarlake.sources.csv_drop import CORRUPT, csv_options, with_corrupt


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file block at line quotes``: numbered within their block in the file's order."""
    line = F.col("value")
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        line.alias("line"),
        (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))).alias("quotes"),
    )


def _records(lines: DataFrame) -> DataFrame:
    """``file block number record``: whole records, in no order."""
    blocks = Window.partitionBy("file").orderBy("block")
    before = blocks.rowsBetween(Window.unboundedPreceding, -1)
    opened = (
        lines.groupBy("file", "block")
        .agg(F.sum("quotes").alias("quotes"))
        .withColumn("open", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
        .drop("quotes")
    )
    inside = Window.partitionBy("file", "block").orderBy("at")
    so_far = F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = ((so_far + F.col("open")) % 2 == 0).cast("int")
    numbered = lines.join(opened, ["file", "block"]).withColumn("begins", begins).withColumn(
        "number", F.sum("begins").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    # Lines before a block's first record belong to the last one that began before.
    last = numbered.groupBy("file", "block").agg(F.max("number").alias("number"))
    held = F.when(F.col("number") > 0, F.struct("block", "number"))
    carried = last.select("file", "block", F.last(held, ignorenulls=True).over(before).alias("from"))
    owned = numbered.join(carried, ["file", "block"]).withColumn(
        "owner", F.when(F.col("number") > 0, F.struct("block", "number")).otherwise(F.col("from"))
    )
    pieces = F.array_sort(F.collect_list(F.struct("block", "at", "line")))
    return owned.groupBy("file", "owner").agg(
        F.array_join(F.transform(pieces, lambda p: p["line"]), "\n").alias("record")
    ).select("file", "owner.*", "record")


@contextmanager
def read_records(
    spark: SparkSession, path: str, contract: Contract, *, corrupt: bool = False
) -> Iterator[DataFrame]:
    """The rows of CSV files whose fields may span lines, for the length of a ``with`` block.

    As ``read_csv(multi_line=True)``: a header that differs is an error, and ``corrupt``
    adds the raw text of records that do not fit. The lines are kept in the shared folder
    meanwhile, as their numbers must not change. A record is one task's row, so a file
    whose quotes never close is one record.
    """
    with passing(_lines(spark, path), "csv-lines") as lines:
        whole = _records(lines)
        head = (F.col("block") == 0) & (F.col("number") == 1)
        wanted = ",".join(contract.columns)
        plain = F.replace(F.rtrim(F.replace("record", F.lit("\r"), F.lit(""))), F.lit('"'), F.lit(""))
        fits = F.when(head & (plain != wanted), F.raise_error(F.concat(F.lit("CSV header differs: "), "record")).cast("boolean"))
        rows = whole.filter(F.coalesce(fits, ~head) & (F.trim("record") != ""))
        schema = with_corrupt(contract) if corrupt else contract.schema
        options = {**csv_options(contract, True), "header": "false", "columnNameOfCorruptRecord": CORRUPT}
        parsed = F.from_csv(F.col("record"), F.lit(schema.simpleString()[7:-1].replace(":", " ")), options)
        yield rows.select(parsed.alias("row")).select("row.*")
