"""CSV records over blocks of text files, so that a file with line breaks inside quotes is read by many tasks.

Whether a line starts a record depends on all quotes before it.  A block does not know them, so it is read for
both cases, outside and inside a quoted field: where it ends, and how many records start in it.  One small row per block
leaves the scan; running through the blocks of a file in order then tells each block's case.  A record
belongs to the block in which it starts; what it has in later blocks is brought to it.

Fields follow the CSV dialect of the deliveries: a quote opens a field at its start only, is doubled inside, and characters behind a closing quote
belong to the field.  Line feed, carriage return, and both together end records.  Blank lines are no records.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE, RETURN = 0x22, 0x0D
# Blocks that start inside a record are sent to all tasks up to this number (a few bytes each).
SENT_BLOCKS = 1_000_000
_BREAK = re.compile(rb"[,\r]")

BLOCK_DDL = (
    "file_key bigint, block_start bigint, ends_0 boolean, ends_1 boolean, opens_1 boolean, records_0 bigint, records_1 bigint, "
    "valid_utf8 boolean, line_safe boolean, header_line string"
)
RECORD_DDL = "path string, owner bigint, block_start bigint, record string"


def file_key(path: Column) -> Column:
    return F.xxhash64(path)


def block_lines(spark: SparkSession, root: str) -> DataFrame:
    """Lines of all files with the block they start in; only line feeds part them, so nothing inside quotes is lost."""
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(root)
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("value").cast("binary").alias("line"),
        F.is_valid_utf8("value").alias("valid"),
    )


def walk(line: bytes, inside: bool) -> tuple[list[bytes], bool]:
    """The pieces of records on a line, and whether a quoted field is open behind it.

    With ``inside`` the first piece continues an earlier record.
    """
    pieces, start, at = [], 0, 0
    while True:
        if not inside and line[at : at + 1] == b'"':
            inside, at = True, at + 1
        if inside:
            quote = line.find(b'"', at)
            while quote >= 0 and line[quote + 1 : quote + 2] == b'"':
                quote = line.find(b'"', quote + 2)
            if quote < 0:
                return [*pieces, line[start:]], True
            inside, at = False, quote + 1
        found = _BREAK.search(line, at)
        if found is None:
            return [*pieces, line[start:]], False
        at = found.end()
        if found.group() == b"\r":
            pieces.append(line[start : found.start()])
            start = at
            if at == len(line):
                return pieces, False


class Lines:
    """Lines of a batch, and which of them need a walk: those with quotes, or with a carriage return before their end.

    Quotes and returns are looked up in the batch as a whole, so a plain line costs no Python object.
    """

    def __init__(self, column: pa.Array):
        self.column = column
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        starts, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
        returns = np.flatnonzero(data == RETURN)
        owner = np.searchsorted(ends, returns, side="right")
        last = returns == ends[owner] - 1
        quoted = np.searchsorted(ends, np.flatnonzero(data == QUOTE), side="right")
        self.special = np.unique(np.concatenate((quoted, owner[~last])))
        closing = np.zeros(len(column), np.int64)
        closing[owner[last]] = 1
        self.closed = closing > 0  # with a carriage return at the end
        self.filled = ends - starts - closing > 0
        # white space only: a record, but Spark's line mode leaves it out
        self.odd = np.zeros(len(column), bool)
        filled = np.flatnonzero(self.filled)
        blank = filled[data[starts[filled]] <= 0x20]
        if len(blank):
            visible = np.concatenate(([0], np.cumsum(data > 0x20)))
            self.odd[blank] = visible[ends[blank]] == visible[starts[blank]]

    def line(self, i: int) -> bytes:
        return self.column[i].as_py()

    def plain(self, i: int) -> bytes:
        return self.line(i).removesuffix(b"\r")


def runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal rows."""
    change = np.zeros(len(columns[0]), bool)
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(np.concatenate(([True], change[1:]))) if len(change) else np.zeros(0, np.int64)
    return list(zip(starts.tolist(), np.append(starts[1:], len(change)).tolist(), strict=True))


class _Block:
    """What is known of a block while its lines go by, for both cases."""

    def __init__(self, key: int, start: int):
        self.key, self.start = key, start
        self.inside, self.records = [False, True], [0, 0]
        self.opened = False  # started inside, and a later record is open
        self.valid = self.safe = True
        self.header: list[bytes] | None = [] if start == 0 else None
        self.header_open = start == 0

    def add(self, lines: Lines, low: int, high: int, valid: bool) -> None:
        self.valid &= valid
        special = lines.special[(lines.special >= low) & (lines.special < high)].tolist()
        self.safe &= not lines.odd[low:high].any()
        filled = np.concatenate(([0], np.cumsum(lines.filled[low:high])))
        at = low
        for i in [*special, high]:
            if self.header_open and at < i:
                if self.inside[0]:
                    self.header += map(lines.line, range(at, i))
                else:
                    self._head([lines.plain(at)], False)
            for case in (0, 1):
                if not self.inside[case]:
                    self.records[case] += int(filled[i - low] - filled[at - low])
            if i == high:
                return
            line = lines.line(i)
            for case in (0, 1):
                pieces, inside = walk(line, self.inside[case])
                started = pieces[1:] if self.inside[case] else pieces
                self.records[case] += sum(1 for p in started if p)
                if case == 0:
                    if self.header_open:
                        self._head(pieces, inside)
                    self.safe &= not (inside or self.inside[0] or len(pieces) > 1 or line.find(b"\r", 0, -1) >= 0)
                elif not inside:
                    self.opened = False
                elif started:
                    self.opened = True
                self.inside[case] = inside
            at = i + 1

    def _head(self, pieces: list[bytes], inside: bool) -> None:
        self.header.append(pieces[0])
        self.header_open = inside and len(pieces) == 1

    def row(self) -> tuple:
        header = None if self.header is None else b"\n".join(self.header).decode("utf-8", "replace")
        return (self.key, self.start, *self.inside, self.opened, *self.records, self.valid, self.safe, header)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block: _Block | None = None
    kinds = [pa.int64(), pa.int64(), *[pa.bool_()] * 3, pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
    names = [part.split()[0] for part in BLOCK_DDL.split(", ")]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)

    for batch in batches:
        rows = []
        lines = Lines(batch.column("line"))
        keys, starts = batch.column("file_key").to_numpy(), batch.column("block_start").to_numpy()
        valid = batch.column("valid").to_numpy(zero_copy_only=False)
        for low, high in runs(keys, starts):
            if block is None or (block.key, block.start) != (keys[low], starts[low]):
                if block is not None:
                    rows.append(block.row())
                block = _Block(int(keys[low]), int(starts[low]))
            block.add(lines, low, high, bool(valid[low:high].all()))
        if rows:
            yield packed(rows)
    if block is not None:
        yield packed([block.row()])


def block_facts(spark: SparkSession, root: str) -> DataFrame:
    """One row per block of every file, from one scan of the lines in their order."""
    lines = block_lines(spark, root).select(file_key(F.col("path")).alias("file_key"), "block_start", "line", "valid")
    return lines.mapInArrow(_described, BLOCK_DDL)


def per_file(blocks: DataFrame) -> DataFrame:
    """Facts of each file, with the blocks that start inside a record and the block where that record starts.

    A block leads from case to case: it keeps it, flips it, or ends alike from both.  The case of a block is what the last of the
    third kind before it says, flipped as often as blocks flip since.
    """
    order = Window.partitionBy("file_key").orderBy("block_start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed, flips = F.col("ends_0") == F.col("ends_1"), F.col("ends_0") & ~F.col("ends_1")
    counted = blocks.withColumn("flips", F.sum(flips.cast("int")).over(order))
    settled = F.last(F.when(fixed, F.struct(F.col("ends_0").cast("int").alias("case"), "flips")), ignorenulls=True).over(before)
    flipped = F.coalesce(F.max("flips").over(before), F.lit(0))
    case = F.pmod(F.coalesce(settled["case"], F.lit(0)) + flipped - F.coalesce(settled["flips"], F.lit(0)), F.lit(2))
    known = counted.withColumn("inside", case == 1)
    opens = F.when(F.col("inside"), F.col("opens_1")).otherwise(F.col("ends_0"))
    owned = known.withColumn("owner", F.last(F.when(opens, F.col("block_start")), ignorenulls=True).over(before))
    carried = F.when(F.col("inside"), F.struct("block_start", "owner"))
    return owned.groupBy("file_key").agg(
        F.bool_and("valid_utf8").alias("valid_utf8"),
        F.bool_and(F.col("line_safe") & ~F.col("inside")).alias("line_safe"),
        F.sum(F.when(F.col("inside"), F.col("records_1")).otherwise(F.col("records_0"))).alias("n_records"),
        F.max("header_line").alias("header_line"),
        F.collect_list(carried).alias("carried"),
    )


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records as text; those that cross blocks in parts, which ``owner`` and ``block_start`` bring together.  The first record of a file goes.

    Plain lines between others leave as they are, a run of them at once; only lines that need a walk, and those inside a quoted field, are taken one by one.
    """
    place, inside, owner, part, headed = None, False, None, [], True

    for batch in filter(len, batches):
        out: list[tuple] = []
        lines = Lines(batch.column("line"))
        keep = lines.filled.copy()  # plain lines that are records
        for low, high in runs(*_places(batch)):
            here = (batch.column("path")[low].as_py(), batch.column("block_start")[low].as_py())
            if place != here:
                if part:
                    out.append((*_ends(place, owner), b"\n".join(part)))
                place, owner, part = here, batch.column("owner")[low].as_py(), []
                inside, headed = owner is not None, here[1] > 0
            path, start = here
            special = lines.special[(lines.special >= low) & (lines.special < high)]
            keep[special] = False
            after = [*special.tolist(), high]
            at, k = low, 0
            while at < high:
                if not inside and at < after[k]:
                    if not headed:
                        headed, keep[at] = True, False
                    at = after[k]
                    continue
                keep[at] = False
                line = lines.line(at)
                if at == after[k]:
                    k += 1
                at += 1
                pieces, ends = walk(line, inside)
                for n, piece in enumerate(pieces):
                    last = n == len(pieces) - 1
                    if n or not inside:  # a record starts
                        owner = start if last and ends else None
                        part = [piece]
                    else:
                        part.append(piece)
                    if last and ends:
                        break
                    if not headed:
                        headed = True
                    elif owner is not None and owner != start:
                        out.append((path, owner, start, b"\n".join(part)))
                    elif len(part) > 1 or part[0]:
                        out.append((path, None, start, b"\n".join(part)))
                    owner, part = None, []
                inside = ends
        if keep.any():
            yield _plain_records(batch, lines, keep)
        if out:
            yield _records(out)
    if part:
        yield _records([(*_ends(place, owner), b"\n".join(part))])


def _places(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that change where the path or the block of the lines does."""
    path = batch.column("path")
    changed = pc.not_equal(path[1:], path[:-1]).to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.cumsum(changed))), batch.column("block_start").to_numpy()


def _plain_records(batch: pa.RecordBatch, lines: Lines, keep: np.ndarray) -> pa.RecordBatch:
    kept = batch.filter(pa.array(keep))
    text = lines.column.filter(pa.array(keep))
    if lines.closed[keep].any():
        text = pc.binary_slice(text, 0, -1) if lines.closed[keep].all() else pa.array([t.removesuffix(b"\r") for t in text.to_pylist()], pa.binary())
    try:
        shown = text.cast(pa.string())
    except pa.ArrowInvalid:
        shown = pa.array([t.decode("utf-8", "replace") for t in text.to_pylist()], pa.string())
    nobody = pa.nulls(len(kept), pa.int64())
    return pa.RecordBatch.from_arrays([kept.column("path"), nobody, kept.column("block_start"), shown], names=["path", "owner", "block_start", "record"])


def _ends(place: tuple[str, int], owner: int | None) -> tuple:
    return place[0], owner, place[1]


def _records(rows: list[tuple]) -> pa.RecordBatch:
    path, owner, start, text = zip(*rows)
    shown = [t.decode("utf-8", "replace") for t in text]
    return pa.RecordBatch.from_arrays(
        [pa.array(path), pa.array(owner, pa.int64()), pa.array(start, pa.int64()), pa.array(shown)], names=["path", "owner", "block_start", "record"]
    )


def records(spark: SparkSession, root: str, facts: DataFrame) -> DataFrame:
    """(path, owner, block_start, record) of all files below a root but their first records; see ``joined_records``."""
    carried = facts.select("path", F.explode("carried").alias("x")).select("path", "x.*")
    lines = block_lines(spark, root).select("path", "block_start", "line")
    n_carried = carried.count()
    if n_carried <= SENT_BLOCKS:  # a join by broadcast keeps the order of the lines
        placed = lines.join(F.broadcast(carried), ["path", "block_start"], "left")
    else:
        numbered = lines.withColumn("position", F.monotonically_increasing_id())
        placed = numbered.join(carried, ["path", "block_start"], "left").repartition("path", "block_start")
        placed = placed.sortWithinPartitions("path", "block_start", "position")
    return placed.select("path", "block_start", "line", "owner").mapInArrow(_assembled, RECORD_DDL)


def joined_records(parts: DataFrame) -> DataFrame:
    """(path, record) with the parts of records that cross blocks put together; a group is the parts of one record."""
    part = F.struct("block_start", "record")
    crossing = parts.where("owner IS NOT NULL").groupBy("path", "owner").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    whole = F.array_join(F.transform("parts", lambda p: p["record"]), "\n")
    return parts.where("owner IS NULL").select("path", "record").unionByName(crossing.select("path", whole.alias("record")))
