"""Bring a DataFrame to declared types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.contracts import Contract


def normalize_types(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """Cast the columns named in ``types``; every other column passes through.

    Values that do not fit become NULL. Columns that already have the type
    are left alone, so the projection disappears where nothing is to do.
    """
    wanted = {
        name: T._parse_datatype_string(t) if isinstance(t, str) else t
        for name, t in types.items()
    }
    changes = {
        f.name: F.col(f.name).try_cast(wanted[f.name])
        for f in df.schema.fields
        if f.name in wanted and f.dataType != wanted[f.name]
    }
    return df.withColumns(changes) if changes else df


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Exactly the contract's columns, in its order and types."""
    types = {f.name: f.dataType for f in contract.schema.fields}
    return normalize_types(df, types).select(*contract.columns)
