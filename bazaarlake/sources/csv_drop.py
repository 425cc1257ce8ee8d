"""CSV drops into the bronze layer: full load and keyed incremental load."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bazaarlake.contracts import RAW, Contract
from bazaarlake.operators.quality import row_counts, validate_counts
from bazaarlake.session import passing, path_exists
from bazaarlake.sources.layers import Lake
from bazaarlake.sources.merge import merge

# Header row, a doubled quote is a quote. Columns are read by position; a header
# that differs from the contract is an error.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "enforceSchema": "false",
}

STATUS_DDL = """table_name string, status string, new_rows bigint,
                total_rows bigint, error string"""


# Holds the raw line of a row that does not fit the contract.
CORRUPT = "_corrupt_record"


def csv_options(contract: Contract, multi_line: bool | None = None) -> dict[str, str]:
    """Options for the contract's files; fields span lines only where it says so."""
    spans = contract.multi_line if multi_line is None else multi_line
    return {**CSV_OPTIONS, "multiLine": str(spans).lower()}


def with_corrupt(contract: Contract) -> StructType:
    return StructType([*contract.schema.fields, StructField(CORRUPT, StringType())])


def set_apart(
    rows: DataFrame, contract: Contract, *, keyed: bool
) -> tuple[DataFrame, DataFrame]:
    """(rows to load, rejects) of rows read with their corrupt lines.

    A row with a value that does not fit its type, or with too few or too many
    fields, is loaded with NULL there, and its raw line is kept as a reject. Where
    rows are merged by key (``keyed``: increments and the stream) a key with a NULL
    part is not loaded: it matches nothing, so that loading it again would add it
    twice. A reject has what was read, the raw line and a reason.
    """
    unreadable = F.col(CORRUPT).isNotNull()
    keys = contract.keys if keyed else ()
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.lit(False))
    reason = F.when(unreadable, "unreadable").otherwise("no key")
    bad = rows.filter(unreadable | no_key).withColumn("reason", reason)
    return rows.filter(~no_key).drop(CORRUPT), bad


def _rejects_of(contract: Contract, path: str) -> str:
    """A folder for the file's rejects: loading it again replaces them."""
    name = hashlib.sha256(path.encode()).hexdigest()[:16]
    return f"{contract.name}_rejects/file={name}"


def _note(rejected: int, strict: bool) -> str | None:
    if rejected and strict:
        raise ValueError(f"{rejected} rows do not fit the contract")
    return f"{rejected} raw rows kept as rejects" if rejected else None


def read_csv(
    spark: SparkSession,
    path: str,
    contract: Contract,
    *,
    multi_line: bool | None = None,
    corrupt: bool = False,
) -> DataFrame:
    """CSV under the contract's schema: no inference pass over the data.

    Spark splits large files, unless the contract (or ``multi_line``) says that
    fields may span lines: such a file is one task. ``corrupt`` adds the raw line
    of rows that do not fit; without it, what cannot be read is NULL.
    """
    options = csv_options(contract, multi_line)
    schema = with_corrupt(contract) if corrupt else contract.schema
    return spark.read.schema(schema).options(**options).csv(path)


class LoadError(RuntimeError):
    """At least one table failed; ``report`` has one row per table."""

    def __init__(self, report: DataFrame, failed: list[str]):
        super().__init__(f"load failed for: {', '.join(failed)}")
        self.report = report


def _run(
    spark: SparkSession,
    tables: Mapping[str, Contract],
    load_one: Callable[[Contract], tuple[str, int | None, int | None, str | None]],
) -> DataFrame:
    """Load every table, then fail if any failed, with all outcomes reported."""
    outcomes, failed = [], []
    for contract in tables.values():
        try:
            outcomes.append((contract.name, *load_one(contract)))
        except Exception as problem:  # noqa: BLE001 - reported, then raised
            failed.append(contract.name)
            outcomes.append((contract.name, "FAILED", None, None, str(problem)))
    report = spark.createDataFrame(outcomes, STATUS_DDL)
    if failed:
        raise LoadError(report, failed)
    return report


def full_load(
    lake: Lake,
    folder: str,
    *,
    file_name: str = "{table}.csv",
    tables: Mapping[str, Contract] = RAW,
    multi_line: Collection[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Replace each bronze table by its CSV. One row per table: name, rows.

    Tables named in ``multi_line``, besides those whose contract says so, may have
    line breaks inside fields. The raw lines of rows that do not fit the contract
    go to ``<table>_rejects`` and are counted in ``error``; ``strict`` fails the
    table instead.
    """

    def load_one(contract: Contract):
        path = f"{folder}/{file_name.format(table=contract.name)}"
        source = read_csv(
            lake.spark,
            path,
            contract,
            multi_line=contract.multi_line or contract.name in multi_line,
            corrupt=True,
        )
        if strict:
            _note(set_apart(source, contract, keyed=False)[1].count(), strict)
        seen = Observation()
        counted = source.observe(seen, F.count(CORRUPT).alias("rejects"))
        good, _ = set_apart(counted, contract, keyed=False)
        rows = lake.write(good, "bronze", contract.name)
        rejected = seen.get["rejects"]
        if rejected:  # read again only then
            _, bad = set_apart(source, contract, keyed=False)
            lake.write(bad, "bronze", _rejects_of(contract, path))
        return "LOADED", rows, rows, _note(rejected, False)

    return _run(lake.spark, tables, load_one)


def incremental_load(
    lake: Lake,
    folder: str,
    *,
    file_name: str = "{table}_new.csv",
    tables: Mapping[str, Contract] = RAW,
    multi_line: Collection[str] = (),
    strict: bool = False,
    merge_with: Callable[[Lake, Contract, DataFrame], int] = merge,
) -> DataFrame:
    """Upsert each table's new rows; tables without new rows are skipped.

    ``merge_with`` does the upsert and returns the table's rows: into a bucketed
    table, for example.

    Rejects are kept as in ``full_load``, rows without a complete key among them;
    loading a file again replaces its rejects.
    """

    def load_one(contract: Contract):
        path = f"{folder}/{file_name.format(table=contract.name)}"
        if not path_exists(lake.spark, path):
            return "NO FILE", 0, None, None
        # Written once: the upsert reads it more than once, and its measured
        # size lets Spark decide whether to broadcast it.
        source = read_csv(
            lake.spark,
            path,
            contract,
            multi_line=contract.multi_line or contract.name in multi_line,
            corrupt=True,
        )
        with passing(source, "increment") as read:
            fresh, bad = set_apart(read, contract, keyed=True)
            rejected = bad.count()
            note = _note(rejected, strict)
            if rejected:
                lake.write(bad, "bronze", _rejects_of(contract, path))
            new_rows = fresh.count()
            if not new_rows:
                return "NO ROWS", 0, None, note
            return "MERGED", new_rows, merge_with(lake, contract, fresh), note

    return _run(lake.spark, tables, load_one)


def validate_layer(
    lake: Lake,
    layer: str,
    tables,
    expected: Mapping[str, int] | None = None,
) -> DataFrame:
    """Row count per table with PASS / FAIL / EXISTS / MISSING."""
    present = {t: lake.read(layer, t) for t in tables if lake.exists(layer, t)}
    absent = [t for t in tables if t not in present]
    spark = lake.spark
    none = spark.createDataFrame([], "table_name string, row_count bigint")
    counts = row_counts(present) if present else none
    wanted = None
    if expected:
        wanted = spark.createDataFrame(
            list(expected.items()), "table_name string, expected_count bigint"
        )
    report = validate_counts(counts, wanted)
    if not absent:
        return report
    gone = spark.createDataFrame([(t,) for t in absent], "table_name string")
    return report.join(gone, "table_name", "left_anti").unionByName(
        gone.select(
            "table_name",
            F.lit(None).cast("bigint").alias("expected_count"),
            F.lit(None).cast("bigint").alias("row_count"),
            F.lit("MISSING").alias("status"),
        )
    )
