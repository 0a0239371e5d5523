"""Secrets in texts, judged by how many repositories and owners hold the same value.

Three kinds of base spans are found by their form: assignments to a secret's name, access ids, and long hexadecimal strings.
Beside them every run of KEY_CHARACTERS that looks drawn at random and touches no base span is a candidate.  The values of all spans are
hashed and counted over the corpus: a value that stands with one owner only looks live, one that EXAMPLE_OWNERS or more hold
is an example that people copy, and what lies between is shared.  Live candidates are added to the spans; base
spans stay whatever their count.

Counting goes from (value, owner, repository) to (value, owner) to value, each step summed before it is shuffled, so a value that
a third of all documents hold gathers one row per task.  Texts are read once and not shuffled; the spans are written to the shared folder.

Null text is empty.  Rows are scanned one by one, so repeated rows give repeated results but are one repository; rows without
repository count as one repository without name, likewise owners.  Spans are code points, end exclusive.  Columns of
the input other than the three named ones are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replaykit.session import written_table

from .textbytes import ASCII_LOWER, Texts, chunks, word_spans

KINDS = ("assign", "access", "hex", "owned")
ASSIGN, ACCESS, HEX, OWNED = range(4)
# on lower-cased bytes; texts are parted by line feeds, which no match holds
ASSIGNMENT = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
# fixed values of what a random key looks like
LEAST_KEY, LEAST_DIFFERENT = 20, 12
EXAMPLE_OWNERS = 3


def _gap(*ranges: str) -> np.ndarray:
    """A table that is false for the bytes of ``a-z``-like ranges and single characters."""
    gap = np.ones(256, bool)
    for r in ranges:
        gap[ord(r[0]) : ord(r[-1]) + 1] = False
    return gap


NO_HEX = _gap("0-9", "a-f")
NO_ACCESS = _gap("A-Z", "0-9")
NO_KEY = _gap("A-Z", "a-z", "0-9", "+", "/", "_", "-")
_CLASS = np.zeros(256, np.uint8)
_CLASS[ord("0") : ord("9") + 1], _CLASS[ord("A") : ord("Z") + 1], _CLASS[ord("a") : ord("z") + 1] = 1, 2, 4


def looks_random(value: bytes) -> bool:
    """Digits, small and capital letters, and many different characters."""
    data = np.frombuffer(value, np.uint8)
    return int(np.bitwise_or.reduce(_CLASS[data])) == 7 and len(np.unique(data)) >= LEAST_DIFFERENT


def spans(texts: Texts) -> list[tuple[int, int, int, int, int]]:
    """(kind, start, end, start of value, end of value) of base spans and candidates in byte places, in order of start and kind."""
    data = texts.data
    found = []
    starts, ends = word_spans(texts, NO_HEX)
    for i in np.flatnonzero(ends - starts >= LEAST_HEX).tolist():
        found.append((HEX, int(starts[i]), int(ends[i]), int(starts[i]), int(ends[i])))
    starts, ends = word_spans(texts, NO_ACCESS)
    for i in np.flatnonzero(ends - starts >= LEAST_ACCESS).tolist():
        at = data[starts[i] : ends[i]].tobytes().find(b"AKIA")
        if at >= 0 and ends[i] - starts[i] - at >= LEAST_ACCESS:
            found.append((ACCESS, int(starts[i]) + at, int(ends[i]), int(starts[i]) + at, int(ends[i])))
    n = len(texts.offsets) - 1
    parted = np.full(len(data) + n, 0x0A, np.uint8)
    parted[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(texts.offsets))] = ASCII_LOWER[data]
    after = texts.offsets[1:] + np.arange(n)  # places of the line feeds that part the texts
    for m in ASSIGNMENT.finditer(parted.tobytes()):
        if m.end(1) - m.start(1) >= LEAST_VALUE:
            back = int(np.searchsorted(after, m.start()))
            found.append((ASSIGN, m.start() - back, m.end() - back, m.start(1) - back, m.end(1) - back))
    base = np.array(sorted((s, e) for _, s, e, _, _ in found), np.int64).reshape(-1, 2)
    reach = np.maximum.accumulate(base[:, 1]) if len(base) else base[:, 1]
    starts, ends = word_spans(texts, NO_KEY)
    long = np.flatnonzero(ends - starts >= LEAST_KEY)
    before = np.searchsorted(base[:, 0], ends[long])  # base spans that start before the run ends
    touched = np.zeros(len(long), bool)
    touched[before > 0] = reach[before[before > 0] - 1] > starts[long[before > 0]]
    for i in long[~touched].tolist():
        if looks_random(data[starts[i] : ends[i]].tobytes()):
            found.append((OWNED, int(starts[i]), int(ends[i]), int(starts[i]), int(ends[i])))
    return sorted(found, key=lambda x: (x[1], x[0]))


SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
FOUND_TYPES = pa.schema([("row", pa.int64()), ("repository", pa.string()), ("owner", pa.string()), ("doc_id", pa.int64()), ("found", pa.list_(SPAN))])
FOUND_DDL = "row bigint, repository string, owner string, doc_id bigint, found array<struct<kind: int, start: bigint, end: bigint, value: string>>"


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        rows: list[list[dict]] = [[] for _ in range(batch.num_rows)]
        for texts in chunks(batch.column("text")):
            hits = spans(texts)
            owner = np.searchsorted(texts.offsets, [h[1] for h in hits], "right") - 1
            points: np.ndarray | None = None
            last = -1
            for doc, (kind, start, end, low, high) in zip(owner.tolist(), hits, strict=True):
                begin = int(texts.offsets[doc])
                if doc != last:
                    own = texts.data[begin : texts.offsets[doc + 1]]
                    points = np.concatenate(([0], np.cumsum((own & 0xC0) != 0x80)))
                    last = doc
                value = hashlib.sha256(texts.data[low:high].tobytes()).hexdigest()
                rows[texts.first + doc].append({"kind": kind, "start": int(points[start - begin]), "end": int(points[end - begin]), "value": value})
        ids = pa.array(np.arange(number, number + batch.num_rows))
        number += batch.num_rows
        columns = [ids, batch.column("repository"), batch.column("owner"), batch.column("doc_id"), pa.array(rows, pa.list_(SPAN))]
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, FOUND_TYPES, strict=True)], schema=FOUND_TYPES)


def ownership(found: DataFrame) -> DataFrame:
    """Per value the numbers of distinct owners and repositories that hold it, and its verdict."""
    held = found.select("repository", "owner", F.explode("found.value").alias("value"))
    held = held.groupBy("value", "owner", "repository").agg(F.lit(1).alias("one")).groupBy("value", "owner").agg(F.count("*").alias("n"))
    counted = held.groupBy("value").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))
    verdict = F.when(F.col("owners") >= EXAMPLE_OWNERS, "example").when(F.col("owners") == 1, "live").otherwise("shared")
    return counted.withColumn("verdict", verdict)


def scanned(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> tuple[DataFrame, DataFrame]:
    """All rows with their spans, and every span (row, kind, start, end, value, owners, repositories, verdict) of every row.

    Spans of kind ``owned`` are candidates; those with verdict ``live`` are secrets.
    """
    name = lambda c: F.coalesce(F.concat(F.lit("="), docs[c].cast("string")), F.lit(""))
    picked = docs.select(
        name(repository).alias("repository"), name(owner).alias("owner"), docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text")
    )
    found = written_table(picked.mapInArrow(_found, FOUND_DDL), "secret-spans")
    single = found.where(F.size("found") > 0).select("row", F.explode("found").alias("x")).select("row", "x.*")
    return found, single.join(ownership(found), "value")


def _listed(spans: str) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    shown = F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(shown, ",")


def summary(docs: DataFrame) -> DataFrame:
    """Per row its base spans counted by kind and digested, all its spans, and the verdicts of their values."""
    found, judged = scanned(docs)
    picked = judged.where((F.col("kind") < OWNED) | (F.col("verdict") == "live"))
    verdicts = [F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("live", "shared", "example")]
    per_row = picked.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("all"), *verdicts)
    base = F.filter("found", lambda x: x["kind"] < OWNED)
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")
    joined = found.withColumn("base", base).join(per_row, "row", "left")
    return joined.select(
        "doc_id", count(ASSIGN), count(ACCESS), count(HEX), F.sha2(_listed("base"), 256).alias("base_sha256"),
        F.coalesce(_listed("all"), F.lit("")).alias("spans"), *[F.coalesce(f"n_{v}", F.lit(0)).alias(f"n_{v}") for v in ("live", "shared", "example")],
    )
