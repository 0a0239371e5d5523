"""Packing of token sequences by best-two-fit.

Texts become token ids followed by an end id; what is longer than a sequence is cut into pieces.  A packing
depends on the lengths of the pieces only, so the plan is made from the number of pieces of each length (at most
CAPACITY figures): a sequence is filled greedily with the longest piece that fits; then its smallest piece is exchanged
for two unpacked ones that fill the widened gap better.  The same filling is repeated while the counts last, so a plan
has few different fillings.  The k-th piece of a length takes the k-th place for this length; places are counted
per length and salt, so a length that a third of all pieces share is spread over many tasks.

Null text is empty and yields the end id alone.  Repeated rows are packed once per row.
"""

from __future__ import annotations

import os
import sys
import types
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replaykit.session import written_table

from .textbytes import ASCII_LOWER, CHUNK_BYTES, Texts, chunks, mix, prefix_sums, span_hashes, word_spans

CAPACITY = 2048
END_ID = 0
CACHED_WORDS = 300_000
ROWS_PER_SALT = 100_000
TAIL = np.zeros(256, bool)
TAIL[list(b".,;:!?$%&*#")] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Words:
    """Token ids of the words seen so far, by hash."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros(1 << 16, np.int64)

    def slots(self, hashes: np.ndarray, words: list) -> np.ndarray:
        """``words`` gives the bytes of the word at an index of ``hashes``."""
        if len(self.slot) > CACHED_WORDS:
            self.clear()
        out = np.array([self.slot.get(h, -1) for h in hashes.tolist()], np.int64)
        missing = np.flatnonzero(out < 0)
        if len(missing):
            encoded = [e.ids for e in self.encoder.encode_batch_fast([words(i) for i in missing.tolist()], add_special_tokens=False)]
            start = len(self.slot)
            used = int(self.first[start])
            ends = used + np.cumsum([len(e) for e in encoded])
            while len(self.first) < start + len(missing) + 1:
                self.first = np.concatenate((self.first, np.zeros_like(self.first)))
            while len(self.ids) < ends[-1]:
                self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
            self.ids[used : ends[-1]] = np.concatenate([np.array(e, np.uint32) for e in encoded])
            self.first[start + 1 : start + len(missing) + 1] = ends
            out[missing] = np.arange(start, start + len(missing))
            self.slot.update(zip(hashes[missing].tolist(), out[missing].tolist(), strict=True))
        return out


def _shared_words(path: str) -> _Words:
    """One tokenizer for each process, so that it outlives a task."""
    holder = sys.modules.setdefault("_packing_words", types.ModuleType("_packing_words"))
    if not hasattr(holder, "by_path"):
        holder.by_path = {}
    if path not in holder.by_path:
        holder.by_path[path] = _Words(path)
    return holder.by_path[path]


def token_ids(texts: Texts, words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and the bounds of each text among them.

    White space separates words for the tokenizer, and so does the step from an ASCII letter to punctuation at
    the end of a word, so each part is encoded by itself.  Lower case is what the tokenizer makes of ASCII letters; words with
    ``|`` keep theirs, as marks such as ``<|endoftext|>`` are matched before.
    """
    starts, ends = word_spans(texts)
    data = ASCII_LOWER[texts.data]
    bars = np.flatnonzero(texts.data == 0x7C)
    for w in np.unique(np.searchsorted(starts, bars, "right") - 1).tolist():
        data[starts[w] : ends[w]] = texts.data[starts[w] : ends[w]]
    stem = ends.copy()
    moving = np.arange(len(stem))
    while len(moving):
        moving = moving[(stem[moving] > starts[moving]) & TAIL[data[stem[moving] - 1]]]
        stem[moving] -= 1
    split = (stem > starts) & (stem < ends)
    split[split] = LETTER[data[stem[split] - 1]]
    part_starts = np.sort(np.concatenate((starts, stem[split])))
    part_ends = np.sort(np.concatenate((ends, stem[split])))
    hashes = np.zeros(len(part_starts), np.uint64)
    at = 0
    while at < len(part_starts):
        stop = max(at + 1, int(np.searchsorted(part_ends, part_starts[at] + CHUNK_BYTES, "right")))
        low, high = int(part_starts[at]), int(part_ends[stop - 1])
        hashes[at:stop] = mix(span_hashes(prefix_sums(data[low:high]), part_starts[at:stop] - low, part_ends[at:stop] - low))
        at = stop
    unique, one, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    raw = data.tobytes()
    slots = words.slots(unique, lambda i: raw[part_starts[one[i]] : part_ends[one[i]]].decode("utf-8", "replace"))[inverse]
    low = words.first[slots]
    sizes = words.first[slots + 1] - low
    ends_at = np.cumsum(sizes)
    ids = words.ids[np.arange(ends_at[-1] if len(ends_at) else 0) + np.repeat(low - (ends_at - sizes), sizes)]
    bounds = np.concatenate(([0], ends_at))[np.searchsorted(part_starts, texts.offsets)]
    return ids, bounds


PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _shared_words(path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            rows = []
            for texts in chunks(batch.column("text")):
                ids, bounds = token_ids(texts, words)
                for i in range(len(bounds) - 1):
                    whole = ids[bounds[i] : bounds[i + 1]].astype("<u4").tobytes() + end
                    for k in range(0, len(whole) // 4, capacity):
                        part = whole[4 * k : 4 * (k + capacity)]
                        rows.append((doc_ids[texts.first + i], k // capacity, k, len(part) // 4, zlib.crc32(part)))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        words.clear()  # an idle worker holds no words

    return run


class Filling(NamedTuple):
    """So many sequences are filled with pieces of these lengths."""

    times: int
    lengths: tuple[int, ...]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Filling]:
    """Fillings that use up all pieces."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []
    while left.any():
        bin_, gap = [], capacity
        free = left.copy()
        while gap:
            fits = np.flatnonzero(free[: gap + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            bin_.append(length)
            free[length] -= 1
            gap -= length
        if gap and bin_:
            pair = _better_pair(free, bin_[-1], bin_[-1] + gap)
            if pair:
                bin_[-1:] = pair
        used = np.bincount(bin_, minlength=capacity + 1)
        times = int((left[used > 0] // used[used > 0]).min())
        left -= used * times
        out.append(Filling(times, tuple(sorted(bin_, reverse=True))))
    return out


def _better_pair(free: np.ndarray, smallest: int, room: int) -> tuple[int, int] | None:
    """Two unpacked lengths, together longer than the smallest and closest to the room."""
    have = np.flatnonzero(free[: room + 1])
    if not len(have):
        return None
    at = np.searchsorted(have, room - have, "right") - 1
    partner = np.where(at >= 0, have[np.maximum(at, 0)], 0)
    twice = (partner == have) & (free[have] < 2)  # its only piece cannot be used twice
    lower = np.where(at >= 1, have[np.maximum(at - 1, 0)], 0)
    partner = np.where(twice, lower, partner)
    total = np.where(partner > 0, have + partner, 0)
    best = int(np.argmax(total))
    return (int(have[best]), int(partner[best])) if total[best] > smallest else None


def places(fillings: list[Filling]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, times, first sequence, offset) for every length of every filling."""
    out, taken, sequence = [], {}, 0
    for f in fillings:
        offset = 0
        for length in dict.fromkeys(f.lengths):
            n = f.lengths.count(length)
            first = taken.get(length, 0)
            out.append((length, first, first + n * f.times, f.times, sequence, offset))
            taken[length] = first + n * f.times
            offset += n * length
        sequence += f.times
    return out


def packed(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = written_table(texts.mapInArrow(_pieces(tokenizer or default_tokenizer(), capacity), PIECE_SCHEMA), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    fields = ["length", "low", "high", "times", "first_sequence", "first_offset"]
    slots = spark.createDataFrame(places(plan(counts, capacity)), T.StructType([T.StructField(f, T.LongType()) for f in fields]))
    salts = 1 + sum(counts.values()) // ROWS_PER_SALT
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = before.withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("place", F.row_number().over(order)).join(before, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("place") - 1)
    # the plan has at most a few thousand rows, whatever the corpus
    seated = ranked.join(F.broadcast(slots), "length").where("rank >= low AND rank < high")
    return seated.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + (F.col("rank") - F.col("low")) % F.col("times")).alias("sequence_id"),
        (F.col("first_offset") + F.col("length") * F.floor((F.col("rank") - F.col("low")) / F.col("times"))).cast("bigint").alias("offset"),
    )
