"""CSV drops as a stream: every new file is upserted once.

The stream's checkpoint remembers which files were read, so a restart goes on
where the last run ended. ``foreachBatch`` may repeat a batch after a failure;
an upsert by key gives the same table again, and rejected rows are written to a
folder named after the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bazaarlake.contracts import Contract
from bazaarlake.operators.upsert import refuse
from bazaarlake.session import passing
from bazaarlake.sources.csv_drop import csv_options, set_apart, with_corrupt
from bazaarlake.sources.layers import Lake
from bazaarlake.sources.merge import merge

# Age and name of the file a row came from: the order files take effect in.
FILE = "_file"


def read_drops(
    lake: Lake, folder: str, contract: Contract, max_files: int | None = None
) -> DataFrame:
    """Stream of the CSV rows in ``folder``, each with the file it came from."""
    reader = lake.spark.readStream.schema(with_corrupt(contract)).options(**csv_options(contract))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    origin = F.struct("_metadata.file_modification_time", "_metadata.file_path")
    return reader.csv(folder).select("*", origin.alias(FILE))


def latest_file_rows(rows: DataFrame, contract: Contract) -> DataFrame:
    """Per key, the rows of the last file that has the key.

    Upserting them at once is upserting the files one after the other, but the
    table is rewritten once per batch instead of once per file. A file that
    repeats a key which an earlier file brought is an error, as it would be
    for the key of a stored row.
    """
    keys = list(contract.keys)
    span = rows.groupBy(*keys).agg(
        F.min(FILE).alias("_first"), F.max(FILE).alias(FILE)
    )
    last = rows.join(span.drop("_first"), [*keys, FILE], "left_semi")
    repeated = (
        last.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    ).join(span.filter(F.col("_first") < F.col(FILE)), keys, "left_semi")
    last = last.select(*contract.columns)
    return last.unionByName(
        refuse(repeated, "a file repeats a key of an earlier file", like=last)
    )


def start_upserts(
    lake: Lake,
    folder: str,
    contract: Contract,
    checkpoint: str,
    max_files: int | None = None,
    merge_with: Callable[[Lake, Contract, DataFrame], int] = merge,
) -> StreamingQuery:
    """Upsert all files not seen before into the bronze table, then stop.

    ``merge_with`` does the upsert; with a bucketed table's merge a batch rewrites only
    the buckets it touches.

    ``max_files`` bounds the files of one batch. Rows without a complete key
    match nothing, so repeating a batch would add them twice; they and rows that
    do not fit the contract go to
    ``<table>_rejects`` instead, in a folder of this stream's own.
    """
    # Batch numbers begin again with every checkpoint, so they need its name.
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def apply(batch: DataFrame, batch_id: int) -> None:
        with passing(batch, f"batch-{batch_id}") as rows:
            good, bad = set_apart(rows, contract, keyed=True)
            lake.write(
                bad.withColumn("file", F.col(f"{FILE}.file_path")).drop(FILE),
                "bronze",
                f"{contract.name}_rejects/stream={stream}/batch_id={batch_id}",
            )
            merge_with(lake, contract, latest_file_rows(good, contract))

    return (
        read_drops(lake, folder, contract, max_files)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
