"""Landing paths, table destinations and URI parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the object-store scheme recorded in provenance rows.
URI_SCHEME = "gs"

_INGESTION_SEGMENT = r"(?:^|/)ingestion_date=([0-9]{4}-[0-9]{2}-[0-9]{2})(?:/|$)"


def landing_path(system: Column, source: Column, ingestion_date: Column, filename: Column) -> Column:
    """``raw/<system>/<object>/ingestion_date=<iso>/<filename>``."""
    return F.concat_ws(
        "/",
        F.lit("raw"),
        system,
        source,
        F.concat(F.lit("ingestion_date="), F.date_format(ingestion_date, "yyyy-MM-dd")),
        filename,
    )


def destination_id(dataset: str, source: Column, partition_date: Column, is_transactional: Column) -> Column:
    """``dataset.table`` for master data, ``dataset.table$YYYYMMDD`` for one day."""
    day = F.when(is_transactional, F.concat(F.lit("$"), F.date_format(partition_date, "yyyyMMdd")))
    return F.concat(F.lit(f"{dataset}."), source, F.coalesce(day, F.lit("")))


def has_uri_scheme(uri: Column, scheme: str = URI_SCHEME) -> Column:
    return uri.startswith(f"{scheme}://")


def uri_bucket(uri: Column, scheme: str = URI_SCHEME) -> Column:
    return _uri_part(uri, scheme, 1)


def uri_object(uri: Column, scheme: str = URI_SCHEME) -> Column:
    return _uri_part(uri, scheme, 2)


def _uri_part(uri: Column, scheme: str, group: int) -> Column:
    part = F.regexp_extract(uri, rf"(?s)^{scheme}://([^/]+)/(.+)$", group)
    return F.when(part != "", part)


def uri_ingestion_date(uri: Column) -> Column:
    """Date of a full ``ingestion_date=`` path segment, null when absent or no real date."""
    text = F.regexp_extract(uri, _INGESTION_SEGMENT, 1)
    return F.when(text != "", text.try_cast("date"))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def has_csv_suffix(path: Column) -> Column:
    """Case-insensitive ``.csv`` extension; a bare ``.csv`` has no extension."""
    return F.lower(file_name(path)).rlike(r"[^.].*\.csv$")
