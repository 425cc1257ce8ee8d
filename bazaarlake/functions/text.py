"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlake.contracts import ZIP_WIDTH


def pad_zip(zip_code: Column) -> Column:
    """Zip prefix as text, zero-padded (and cut) to five characters."""
    return F.lpad(zip_code.cast("string"), ZIP_WIDTH, "0")


def tidy(text: Column) -> Column:
    """Trimmed lower-case text."""
    return F.lower(F.trim(text))


def spaced(text: Column) -> Column:
    """Underscores become spaces."""
    return F.translate(text, "_", " ")
