"""CSV header lines as arrays of column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def header_columns(line: Column) -> Column:
    """Split a header line: drop the byte-order mark, the line end and plain quotes."""
    text = F.regexp_replace(line, "^\\uFEFF|\r$", "")
    names = F.split(text, ",", -1)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.transform(names, lambda name: F.regexp_replace(name, '^"(.*)"$', "$1"))
    )


def missing_columns(required: Column, header: Column) -> Column:
    """Required names the header lacks, sorted; extra names and order are free."""
    return F.array_sort(F.array_except(required, header))
