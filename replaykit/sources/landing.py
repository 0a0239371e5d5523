"""Immutable landing facts of delivered files and the outcome of landing them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import landing_path
from ..operators.runs import classify
from .blocks import file_key, runs
from .deliveries import file_checks, file_facts, header_contract, record_counts
from .registry import with_registry

BYTE_ORDER_MARK = b"\xef\xbb\xbf"


def checksums(spark: SparkSession, root: str) -> DataFrame:
    """SHA-256 and size of every file, by one route for any size and any store that Spark reads.

    Files are read in blocks as lines.  A file of one block is digested where it is read, and only its digest is
    shuffled; of others the lines go on in pieces of PIECE bytes, are brought together in order and streamed through
    the digest, so memory does not depend on a file's size.  The reader leaves out a byte-order mark and does not tell whether the
    last line ends; the file's size tells both: three bytes and one.
    """
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(root).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("file_size_bytes"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_block_length").alias("block_length"),
        file_key(F.col("_metadata.file_path")).alias("file_key"),
        F.col("value").cast("binary").alias("value"),
    )
    pieces = lines.mapInArrow(_pieces, PIECES_DDL).repartition("path").sortWithinPartitions("path", "block_start", "position")
    return pieces.mapInArrow(_digested, "path string, file_size_bytes bigint, checksum string")


PIECE = 1 << 20
STEP = 1000  # lines that are taken at once
PIECES_DDL = "path string, file_size_bytes bigint, block_start bigint, position bigint, value binary, checksum string"


class _Digest:
    """SHA-256 over the pieces of a file, with and without the byte-order mark that the reader leaves out."""

    def __init__(self, size: int):
        self.size, self.seen, self.gap = size, 0, b""
        self.plain, self.marked = hashlib.sha256(), hashlib.sha256(BYTE_ORDER_MARK)

    def add(self, lines: bytes) -> None:
        for part in (self.gap, lines):
            self.plain.update(part)
            self.marked.update(part)
            self.seen += len(part)
        self.gap = b"\n"

    def hex(self) -> str:
        missing = self.size - self.seen
        whole = self.marked if missing >= len(BYTE_ORDER_MARK) else self.plain
        if missing % len(BYTE_ORDER_MARK) == 1:
            whole.update(b"\n")
        return whole.hexdigest()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of files that are one block, and numbered pieces of the lines of other blocks."""
    place, held, size, position = None, [], 0, 0
    digest: _Digest | None = None

    def row(value: bytes | None, checksum: str | None) -> pa.RecordBatch:
        path, file_size, start, _ = place
        cells = [path, file_size, start, position, value, checksum]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
        names = [part.split()[0] for part in PIECES_DDL.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds, strict=True)], names=names)

    def flushed() -> Iterator[pa.RecordBatch]:
        nonlocal held, size, position
        if held:
            lines, held, size = b"\n".join(held), [], 0
            if digest is not None:
                digest.add(lines)
            else:
                yield row(lines, None)
                position += 1

    def ended() -> Iterator[pa.RecordBatch]:
        yield from flushed()
        if digest is not None:
            yield row(None, digest.hex())

    for batch in batches:
        for low, high in runs(batch.column("file_key").to_numpy(), batch.column("block_start").to_numpy()):
            now = tuple(batch.column(n)[low].as_py() for n in ("path", "file_size_bytes", "block_start", "block_length"))
            if now != place:
                yield from ended()
                place, digest = now, _Digest(now[1]) if now[3] >= now[1] else None
            for at in range(low, high, STEP):
                values = batch.column("value").slice(at, min(STEP, high - at))
                held += values.to_pylist()
                size += values.nbytes
                if size >= PIECE:
                    yield from flushed()
    yield from ended()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each file, whose pieces come in order."""

    def rows() -> Iterator:
        for batch in batches:
            for i in range(batch.num_rows):
                yield tuple(batch.column(n)[i].as_py() for n in ("path", "file_size_bytes", "value", "checksum"))

    for (path, size), group in groupby(rows(), key=lambda r: r[:2]):
        digest, known = _Digest(size), None
        for _, _, value, checksum in group:
            if checksum is None:
                digest.add(value)
            known = checksum
        found = [pa.array([path]), pa.array([size], pa.int64()), pa.array([known or digest.hex()])]
        yield pa.RecordBatch.from_arrays(found, names=["path", "file_size_bytes", "checksum"])


def landing_manifest(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """Landing path, checksum and size of every delivered file.

    ``files`` carries ``path``, ``source_object``, ``source_file_name`` and
    ``ingestion_date``.
    """
    keys = files.select("path", "source_object", "source_file_name", "ingestion_date")
    named = with_registry(keys).select(
        "path",
        "source_object",
        "source_system",
        "source_file_name",
        "ingestion_date",
        landing_path(
            F.col("source_system"), F.col("source_object"), F.col("ingestion_date"), F.col("source_file_name")
        ).alias("landing_path"),
    )
    return named.join(checksums(spark, root), "path")


def landing_conflicts(manifest: DataFrame, existing: DataFrame, order_by: str = "path") -> DataFrame:
    """Flag rows whose landing path is taken, by an earlier landing or by a first row of this one.

    The first claimant of each path is an aggregate that combines before the
    shuffle; no path's rows are gathered, however many claim it.  ``order_by``
    must be unique per row.
    """
    taken = existing.select("landing_path", F.lit(True).alias("taken")).distinct()
    first = manifest.groupBy("landing_path").agg(F.min(order_by).alias("first_claim"))
    claims = first.join(taken, "landing_path", "left").select(
        "landing_path", "first_claim", F.coalesce("taken", F.lit(False)).alias("taken")
    )
    return (
        manifest.join(claims, "landing_path")
        .withColumn("conflict", F.col("taken") | (F.col(order_by) != F.col("first_claim")))
        .drop("taken", "first_claim")
    )


def ingestion_outcomes(
    spark: SparkSession, root: str, ingestion_date, existing: DataFrame, facts: DataFrame | None = None
) -> DataFrame:
    """Validate, count and land every delivered file; one row per file with its outcome.

    ``ingestion_date`` is a Column over the file rows.  Rows that are not
    ``success`` must not be appended to the landing manifest.
    """
    facts = file_facts(spark, root) if facts is None else facts
    checked = file_checks(facts.drop("file_size_bytes"), facts)
    contract = header_contract(checked).withColumn("ingestion_date", ingestion_date)
    valid = (
        (F.col("file_check") == "ok")
        & F.coalesce("valid_utf8", F.lit(False))
        & F.col("header_ok")
    )
    judged = contract.withColumn("valid", valid)
    counts = record_counts(spark, root, facts).select("path", "record_count")
    # only files that will land may claim a landing path
    manifest = landing_manifest(spark, root, judged.filter(valid)).select("path", "landing_path", "checksum")
    landed = landing_conflicts(manifest, existing).withColumn("landed", ~F.col("conflict"))
    joined = judged.join(counts, "path", "left").join(landed, "path", "left")
    return classify(joined.withColumn("counted", F.col("record_count") >= 0))
