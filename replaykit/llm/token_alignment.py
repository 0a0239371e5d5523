"""Alignment of two tokenizers over a corpus by an identity map.

Every text is encoded by a byte-level tokenizer A (with a space before it) and a piece tokenizer B (which adds that space).
Places where tokens of both end cut a text into groups; tokens whose byte ranges overlap are linked.  Every stretch between
neighbouring token ends of either side lies in one token of each, so stretches and links are the same thing.

How often an id pair is linked is counted corpus-wide.  For each A id the B id of the same bytes is known beforehand, so a
group of one token each that follows this map is counted in a vector as long as A's vocabulary.  All other links are
counted per chunk of texts (CHUNK_BYTES_OUT) for each distinct pair, and only these sums enter the shuffle, so a pair
that holds a third of all links arrives once per chunk.  The counts come back to the chunks by the same pairs, and each chunk
adds them up for its documents.  What reaches the driver is bounded by A's vocabulary.

A text is encoded in units that start with a space or line feed after a visible character, because no token of either
vocabulary reaches over such a place; the vocabularies are checked for that.  A unit's tokens, groups and links
are worked out once while it stays in the worker's table.

Null and empty texts, and texts whose tokens do not give back their bytes on both sides (say, those with U+2581), have no tokens:
zeros and an empty digest.  Rows are taken one by one, so repeated rows and repeated ids count each time; of the input's columns
only doc_id and text are read.  Ties for the highest count of a B id all count as highest.
"""

from __future__ import annotations

import hashlib
import os
import sys
import types
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replaykit.session import written_table

from .textbytes import Texts, chunks, mix, prefix_sums, span_hashes

CACHED_UNITS = 200_000
CHUNK_BYTES_OUT = 4 << 20
PIECE_BYTES = 1 << 20


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _bytes_of_characters() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones themselves, the rest from 256 upwards."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabularies:
    """Both tokenizers with the bytes of their ids and the map from A ids to B ids of the same bytes (-1: none)."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        to_byte = _bytes_of_characters()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        single = [self.b.is_byte(i) for i in range(len(pieces))]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if s else p.replace("▁", " ").encode() for p, s in zip(pieces, single, strict=True)]
        self.single_b = np.array(single)
        by_bytes: dict[bytes, int] = {}
        for i in sorted(range(len(pieces)), key=lambda i: (single[i], i)):
            if not (self.b.is_control(i) or self.b.is_unknown(i)):
                by_bytes.setdefault(self.bytes_b[i], i)
        self.same = np.array([by_bytes.get(x, -1) for x in self.bytes_a], np.int64)
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.space_b = by_bytes.get(b" ", -1)
        if any(b"\n" in x and len(x) > 1 for x in self.bytes_b) or any(x.strip(b" ") and b" " in x[1:] for x in self.bytes_b):
            raise ValueError("a piece of the second vocabulary reaches over the start of a unit")
        dec_a, dec_b = [str(i) for i in range(len(self.bytes_a))], [str(i) for i in range(len(pieces))]
        # a token's text with what follows it: within its side, or at the end of its side of the group
        self.shown = [x + "," for x in dec_a] + [x + "|" for x in dec_a] + [x + "," for x in dec_b] + [x + ";" for x in dec_b]

    def code(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * len(self.bytes_b) + b


class Aligned(NamedTuple):
    """Tokens of consecutive units: figures per unit, and all links as pair codes with a mark of those in regular groups."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    link_bounds: np.ndarray
    codes: np.ndarray
    regular: np.ndarray
    shown: list[bytes]
    valid: np.ndarray


def align(units: list[bytes], v: Vocabularies) -> Aligned:
    """Tokens of both sides for each unit, cut into groups."""
    texts = [u.decode("utf-8", "surrogateescape") for u in units]
    ids_a = [e.ids for e in v.a.encode_batch_fast(texts, add_special_tokens=False)]
    ids_b = v.b.encode([t[1:] if t.startswith(" ") else t for t in texts], num_threads=1)
    valid = np.zeros(len(units), bool)
    for i, u in enumerate(units):
        if not texts[i].startswith(" ") and ids_b[i][:1] == [v.space_b]:
            ids_b[i] = ids_b[i][1:]  # the space that B adds is not in the text here
        valid[i] = b"".join([v.bytes_b[x] for x in ids_b[i]]) == u == b"".join([v.bytes_a[x] for x in ids_a[i]])
        if not valid[i]:
            ids_a[i], ids_b[i] = [], []
    n_a, n_b = np.array([len(x) for x in ids_a], np.int64), np.array([len(x) for x in ids_b], np.int64)
    a = np.fromiter((x for ids in ids_a for x in ids), np.int64, n_a.sum())
    b = np.fromiter((x for ids in ids_b for x in ids), np.int64, n_b.sum())
    end_a, end_b = np.cumsum(v.length_a[a]), np.cumsum(v.length_b[b])
    ends = np.union1d(end_a, end_b)
    of_a, of_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
    closes = (end_a[of_a] == ends) & (end_b[of_b] == ends) if len(ends) else np.zeros(0, bool)
    opens = np.concatenate(([True], closes[:-1])) if len(ends) else closes
    regular = closes & opens & (v.same[a[of_a]] == b[of_b])
    cuts = ends[closes]
    group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
    last_a, last_b = cuts[group_a] == end_a, cuts[group_b] == end_b
    order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
    na, nb = len(v.bytes_a), len(v.bytes_b)
    shown = np.concatenate((a + na * last_a, 2 * na + b + nb * last_b))[order].tolist()
    pieces = [v.shown[i] for i in shown]
    unit_ends = np.cumsum(np.where(valid, [len(u) for u in units], 0))
    bounds = np.concatenate(([0], np.cumsum(n_a + n_b))).tolist()
    return Aligned(
        n_a, n_b,
        np.diff(np.searchsorted(cuts, unit_ends, "right"), prepend=0),
        np.concatenate(([0], np.searchsorted(ends, unit_ends, "right"))),
        v.code(a[of_a], b[of_b]), regular,
        ["".join(pieces[s:e]).encode() for s, e in zip(bounds, bounds[1:])],
        valid,
    )


class _Units:
    """Alignments of the units seen so far, by hash."""

    def __init__(self, path_a: str, path_b: str):
        self.v = Vocabularies(path_a, path_b)
        self.clear()

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.shown: list[bytes] = []
        self.figures = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, valid
        self.first = np.zeros(1, np.int64)
        self.codes = np.zeros(0, np.int64)
        self.regular = np.zeros(0, bool)
        self._parts: list[Aligned] = []

    def slots(self, hashes: np.ndarray, unit) -> np.ndarray:
        """``unit`` gives the bytes of the unit at an index of ``hashes``."""
        out = np.array([self.slot.get(h, -1) for h in hashes.tolist()], np.int64)
        missing = np.flatnonzero(out < 0)
        if len(missing):
            start = len(self.slot)
            self._parts.append(align([unit(i) for i in missing.tolist()], self.v))
            self.shown += self._parts[-1].shown
            out[missing] = np.arange(start, start + len(missing))
            self.slot.update(zip(hashes[missing].tolist(), out[missing].tolist(), strict=True))
        return out

    def settle(self) -> None:
        """Join what was added to the tables."""
        if not self._parts:
            return
        parts, self._parts = self._parts, []
        self.figures = np.concatenate([self.figures, *[np.stack((p.n_a, p.n_b, p.n_groups, p.valid), 1) for p in parts]])
        sizes = np.concatenate([np.diff(self.first), *[np.diff(p.link_bounds) for p in parts]])
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        self.codes = np.concatenate([self.codes, *[p.codes for p in parts]])
        self.regular = np.concatenate([self.regular, *[p.regular for p in parts]])


def _shared_units(paths: tuple[str, str]) -> _Units:
    """One table for each process, so that it outlives a task."""
    holder = sys.modules.setdefault("_token_alignment_units", types.ModuleType("_token_alignment_units"))
    if getattr(holder, "paths", None) != paths:
        holder.paths, holder.units = paths, _Units(*paths)
    return holder.units


def spaced(texts: Texts) -> Texts:
    """The texts with a space before each."""
    n = len(texts.offsets) - 1
    out = np.full(len(texts.data) + n, 0x20, np.uint8)
    out[np.arange(len(texts.data)) + np.repeat(np.arange(1, n + 1), np.diff(texts.offsets))] = texts.data
    return Texts(texts.first, out, texts.offsets + np.arange(n + 1))


def unit_starts(texts: Texts) -> np.ndarray:
    """Starts of the units: each text, and each space or line feed after a visible character but a space that ends its text."""
    d = texts.data
    before = np.zeros(len(d), bool)
    plain = (d > 0x20) & (d < 0x7F)
    tail = (d >= 0x80) & (d < 0xC0)
    before[1:] = plain[:-1]
    # characters of two bytes from U+00C0 on hold no white space; after longer ones no unit starts
    before[2:] |= tail[1:-1] & (d[:-2] >= 0xC3) & (d[:-2] < 0xE0)
    cut = before & ((d == 0x20) | (d == 0x0A))
    ends = texts.offsets[1:] - 1
    cut[ends[d[ends] == 0x20]] = False
    cut[texts.offsets[:-1]] = True
    return np.flatnonzero(cut)


CHUNK_TYPES = [
    ("chunk", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("figures", pa.binary()), ("digest", pa.list_(pa.string())),
    ("units", pa.binary()), ("unit_bounds", pa.binary()), ("links", pa.binary()), ("link_bounds", pa.binary()),
    ("pairs", pa.list_(pa.int64())), ("pair_counts", pa.list_(pa.int64())), ("same", pa.list_(pa.int32())), ("same_counts", pa.list_(pa.int64())),
]
CHUNK_DDL = (
    "chunk bigint, doc_id array<bigint>, figures binary, digest array<string>, units binary, unit_bounds binary, links binary, "
    "link_bounds binary, pairs array<bigint>, pair_counts array<bigint>, same array<int>, same_counts array<bigint>"
)


def _planes(numbers: np.ndarray) -> bytes:
    """Small numbers, compressed by planes of their bytes."""
    return zlib.compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _numbers(planes: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(planes), np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()


class _Chunk:
    """Texts encoded since the last row was written."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.ids: list = []
        self.slots: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def row(self, table: _Units) -> pa.RecordBatch:
        table.settle()
        slots = np.concatenate(self.slots)
        bounds = np.concatenate(([0], np.cumsum(np.concatenate(self.counts))))
        docs = len(bounds) - 1
        owner = np.repeat(np.arange(docs), np.diff(bounds))
        sound = np.bincount(owner, 1 - table.figures[slots, 3], docs) == 0
        slots, owner = slots[sound[owner]], owner[sound[owner]]
        bounds = np.searchsorted(owner, np.arange(docs + 1))
        unit, local, count = np.unique(slots, return_inverse=True, return_counts=True)
        often = np.argsort(-count, kind="stable")  # frequent units get small numbers
        unit, local = unit[often], np.argsort(often)[local]
        sums = lambda per_unit: np.diff(np.concatenate(([0], np.cumsum(per_unit[local])))[bounds])
        low, n_links = table.first[unit], np.diff(table.first)[unit]
        places = np.arange(n_links.sum()) + np.repeat(low - (np.cumsum(n_links) - n_links), n_links)
        codes, regular = table.codes[places], table.regular[places]
        times = np.repeat(np.bincount(local, minlength=len(unit)), n_links)
        pairs, at = np.unique(codes[~regular], return_inverse=True)
        pair_counts = np.bincount(at, times[~regular], len(pairs)).astype(np.int64)
        same_id = codes[regular] // len(table.v.bytes_b)
        vector = np.bincount(same_id, times[regular], len(table.v.bytes_a)).astype(np.int64)
        links = np.zeros(len(codes), np.int32)  # a place among the pairs, or an id of A below zero
        links[~regular] = at
        links[regular] = -1 - same_id
        used = np.flatnonzero(vector)
        figures = np.stack([*[sums(table.figures[unit, c]) for c in range(3)], sums(n_links)])
        shown = [table.shown[i] for i in slots.tolist()]
        digests = [hashlib.sha256(b"".join(shown[s:e])[:-1]).hexdigest() if e > s else "" for s, e in zip(bounds.tolist(), bounds[1:].tolist())]
        values = [
            self.number, self.ids, figures.astype("<i8").tobytes(), digests, _planes(local), bounds.astype("<u8").tobytes(),
            _planes(links), np.concatenate(([0], np.cumsum(n_links))).astype("<u8").tobytes(),
            pairs, pair_counts, used.astype(np.int32), vector[used],
        ]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, (_, t) in zip(values, CHUNK_TYPES, strict=True)], schema=pa.schema(CHUNK_TYPES))


def _encoded(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _shared_units(paths)
        number = TaskContext.get().partitionId() << 32
        chunk = _Chunk(number)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for part in chunks(batch.column("text"), PIECE_BYTES):
                if len(table.slot) > CACHED_UNITS:
                    if chunk.ids:
                        yield chunk.row(table)
                    table.clear()
                    number += 1
                    chunk = _Chunk(number)
                _add(chunk, ids, part, table)
                if chunk.size >= CHUNK_BYTES_OUT:
                    yield chunk.row(table)
                    number += 1
                    chunk = _Chunk(number)
        if chunk.ids:
            yield chunk.row(table)

    return run


def _add(chunk: _Chunk, ids: list, part: Texts, table: _Units) -> None:
    filled = np.diff(part.offsets) > 0
    texts = spaced(part)
    starts = unit_starts(texts)
    ends = np.append(starts[1:], len(texts.data))
    hashes = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # piecewise, so that the tables of powers stay small
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE_BYTES, "right")))
        low, high = int(starts[at]), int(ends[stop - 1])
        hashes[at:stop] = mix(span_hashes(prefix_sums(texts.data[low:high]), starts[at:stop] - low, ends[at:stop] - low))
        at = stop
    unique, one, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    raw = texts.data.tobytes()
    slots = table.slots(unique, lambda i: raw[starts[one[i]] : ends[one[i]]])[inverse]
    counts = np.diff(np.searchsorted(starts, texts.offsets))
    chunk.slots.append(slots[np.repeat(filled, counts)])
    chunk.counts.append(np.where(filled, counts, 0))
    chunk.ids += ids[part.first : part.first + len(filled)]
    chunk.size += len(texts.data)


RESULT_TYPES = [
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string()),
]
RESULT_DDL = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _summed(same_total: np.ndarray, same_best: np.ndarray):
    """Per document the number of links that are their B id's most frequent, and the sum of all counts."""

    def run(chunk: pa.Table, counted: pa.Table) -> pa.Table:
        values = {name: chunk.column(name)[0].as_py() for name in ("figures", "units", "unit_bounds", "links", "link_bounds")}
        pairs = np.asarray(chunk.column("pairs").combine_chunks().values)
        code, pair_total, pair_best = (counted.column(c).to_numpy() for c in ("code", "total", "best"))
        order = np.argsort(code)
        place = order[np.searchsorted(code[order], pairs)]
        links = _numbers(values["links"])
        total, best = np.zeros(len(links), np.int64), np.zeros(len(links), np.int64)
        same = links < 0
        total[same], best[same] = same_total[-1 - links[same]], same_best[-1 - links[same]]
        if len(pairs):
            total[~same], best[~same] = pair_total[place][links[~same]], pair_best[place][links[~same]]
        by_unit = np.frombuffer(values["link_bounds"], "<u8").astype(np.int64)
        units, by_doc = _numbers(values["units"]), np.frombuffer(values["unit_bounds"], "<u8").astype(np.int64)

        def per_doc(of_links: np.ndarray) -> np.ndarray:
            of_unit = np.diff(np.concatenate(([0], np.cumsum(of_links)))[by_unit])
            return np.diff(np.concatenate(([0], np.cumsum(of_unit[units])))[by_doc])

        figures = np.frombuffer(values["figures"], "<i8").reshape(4, -1)
        columns = [chunk.column("doc_id").combine_chunks().values, *figures, per_doc(best), per_doc(total), chunk.column("digest").combine_chunks().values]
        return pa.Table.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, RESULT_TYPES, strict=True)], schema=pa.schema(RESULT_TYPES))

    return run


def identity(encoded: DataFrame, v: Vocabularies) -> DataFrame:
    """(a, code) of each id of A that B has with the same bytes; as long as A's vocabulary at most."""
    a = np.flatnonzero(v.same >= 0)
    return encoded.sparkSession.createDataFrame(pa.table({"a": pa.array(a, pa.int32()), "code": v.code(a, v.same[a])}))


def pair_counts(encoded: DataFrame, v: Vocabularies) -> DataFrame:
    """(code, total, best) for every linked id pair of the corpus: how often it is linked, and whether its B id has no pair more often."""
    irregular = encoded.select(F.explode(F.arrays_zip("pairs", "pair_counts")).alias("x")).select(F.col("x.pairs").alias("code"), F.col("x.pair_counts").alias("n"))
    vector = encoded.select(F.explode(F.arrays_zip("same", "same_counts")).alias("x")).groupBy(F.col("x.same").alias("a")).agg(F.sum("x.same_counts").alias("n"))
    totals = irregular.unionByName(vector.join(identity(encoded, v), "a").select("code", "n")).groupBy("code").agg(F.sum("n").alias("total"))
    totals = written_table(totals, "pair-counts")
    of_b = F.pmod("code", F.lit(len(v.bytes_b)))
    most = totals.groupBy(of_b.alias("b")).agg(F.max("total").alias("most"))
    return totals.withColumn("b", of_b).join(most, "b").select("code", "total", (F.col("total") == F.col("most")).cast("bigint").alias("best"))


def aligned(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """One row per document: its tokens on both sides, groups and links, and how frequent its links are corpus-wide."""
    paths = paths or default_tokenizers()
    v = Vocabularies(*paths)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    encoded = written_table(docs.mapInArrow(_encoded(paths), CHUNK_DDL), "encoded-chunks")
    counts = written_table(pair_counts(encoded, v), "pair-verdicts")
    same_total, same_best = np.zeros(len(v.same), np.int64), np.zeros(len(v.same), np.int64)
    # at most one row per id of A comes to the driver
    for a, total, best in counts.join(identity(encoded, v), "code").select("a", "total", "best").collect():
        same_total[a], same_best[a] = total, best
    wanted = encoded.select(F.col("chunk").alias("owner"), F.explode("pairs").alias("code")).join(counts, "code")
    return encoded.groupBy("chunk").cogroup(wanted.groupBy("owner")).applyInArrow(_summed(same_total, same_best), RESULT_DDL)
