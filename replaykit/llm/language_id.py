"""Language identification with interpolated Kneser-Ney character models.

Per language an order-4 model is fitted on a bounded sample of labelled documents.  A gram is its four 16-bit
symbols in one number; models are arrays sorted by it.  All grams seen in any language share one array with a column
of log probabilities per language, so scoring looks each place of a text up once; unseen grams back off through
the arrays of contexts and shorter grams.  The language with the lowest cross-entropy per character wins; the
score is its share in a softmax of the code lengths.  Rejection is calibrated on a tenth of the sample, chosen by
the text so that copies stay together, which no model is fitted on: a text whose cross-entropy lies above the mean of its language there by
REJECT_DEVIATIONS standard deviations is flagged.  A language with fewer than CALIBRATION_LEAST such texts rejects nothing.

Text that is null or has no letter is ``und`` with score 0.  Ties go to the language first in order.  Rows are judged one by
one.  Without any labelled row every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textbytes import chunks

ORDER = 4
SAMPLE_DOCUMENTS = 1500
CODE_CHARACTERS = 50
REJECT_DEVIATIONS = 6.0
REJECT_CHARACTERS = 40
CALIBRATION_EVERY = 10
CALIBRATION_LEAST = 5
UNKNOWN = "und"
STEP_BYTES = 1 << 20
_SUFFIX = [np.uint64((1 << (16 * k)) - 1) for k in range(ORDER + 1)]


def symbols(text: str) -> np.ndarray:
    """Lower-cased code points folded to 16 bits: digits, white space and other ASCII marks each as one symbol."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    folded = np.where(codes > 0xFFFF, (codes & 0x7FFF) | 0x8000, codes).astype(np.uint16)
    return np.where(folded < 128, _ASCII[np.minimum(folded, 127)], folded)


_ASCII = np.full(128, ord("."), np.uint16)
_ASCII[:33] = 32
_ASCII[48:58] = ord("0")
_ASCII[97:123] = np.arange(97, 123)


def grams(line: np.ndarray) -> np.ndarray:
    """The gram that ends at each place; three blanks stand before the text."""
    padded = np.concatenate((np.full(ORDER - 1, 32, np.uint16), line)).astype(np.uint64)
    out = np.zeros(len(line), np.uint64)
    for k in range(ORDER):
        out = (out << np.uint64(16)) | padded[k : k + len(line)]
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        texts = batch.column("text").to_pylist()
        for lang in sorted(set(langs)):
            own = [grams(symbols(texts[i] or "")) for i in np.flatnonzero(langs == lang)]
            keys, counts = np.unique(np.concatenate(own), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"]
            )


class Level(NamedTuple):
    """Sorted grams of one length with log probabilities, and sorted contexts with log back-off weights."""

    grams: np.ndarray
    values: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray


class Model(NamedTuple):
    languages: list[str]
    levels: list[Level]  # of lengths ORDER to 1
    floor: np.ndarray
    limits: np.ndarray | None


def _fit_one(keys: np.ndarray, counts: np.ndarray, vocabulary: int) -> list[tuple]:
    """Interpolated Kneser-Ney of one language: per length its grams, probabilities, contexts and back-off weights."""
    tables = [(keys, counts.astype(np.float64))]
    for length in range(ORDER - 1, 0, -1):  # lower orders count distinct predecessors
        tables.append(tuple(np.unique(tables[-1][0] & _SUFFIX[length], return_counts=True)))
    out, below = [], None
    for length, (grams_, n) in zip(range(1, ORDER + 1), reversed(tables), strict=True):
        n = n.astype(np.float64)
        ones, twos = (n == 1).sum(), (n == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        contexts, group = np.unique(grams_ >> np.uint64(16), return_inverse=True)
        totals = np.bincount(group, n)
        weights = discount * np.bincount(group) / totals
        shorter = np.full(len(grams_), 1.0 / vocabulary) if below is None else _lookup(below, grams_ & _SUFFIX[length - 1], vocabulary, length - 1)
        p = (n - discount) / totals[group] + weights[group] * shorter
        below = [*(below or []), (grams_, p, contexts, weights)]
        out = below
    return out


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return at, (table[at] == keys if len(table) else np.zeros(len(keys), bool))


def _lookup(tables: list[tuple], keys: np.ndarray, vocabulary: int, length: int) -> np.ndarray:
    """Probabilities of grams of this length under the tables of one language."""
    if length == 0:
        return np.full(len(keys), 1.0 / vocabulary)
    grams_, p, contexts, weights = tables[length - 1]
    at, hit = _find(grams_, keys)
    out = np.where(hit, p[at], 0.0)
    miss = ~hit
    if miss.any():
        c, known = _find(contexts, keys[miss] >> np.uint64(16))
        factor = np.where(known, weights[c], 1.0)
        out[miss] = factor * _lookup(tables, keys[miss] & _SUFFIX[length - 1], vocabulary, length - 1)
    return out


def fit(counted: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    languages = sorted(counted)
    seen = np.unique(np.concatenate([k & _SUFFIX[1] for k, _ in counted.values()]))
    vocabulary = len(seen) + 1
    fitted = {x: _fit_one(*counted[x], vocabulary) for x in languages}
    levels = []
    for length in range(ORDER, 0, -1):
        every = np.unique(np.concatenate([fitted[x][length - 1][0] for x in languages]))
        contexts = np.unique(np.concatenate([fitted[x][length - 1][2] for x in languages]))
        values = np.stack([np.log2(_lookup(fitted[x], every, vocabulary, length)) for x in languages], 1)
        weights = []
        for x in languages:
            at, known = _find(fitted[x][length - 1][2], contexts)
            weights.append(np.log2(np.where(known, fitted[x][length - 1][3][at], 1.0)))
        levels.append(Level(every, values.astype(np.float32), contexts, np.stack(weights, 1).astype(np.float32)))
    return Model(languages, levels, np.full(len(languages), -np.log2(vocabulary), np.float32), None)


def log_probabilities(model: Model, keys: np.ndarray, level: int = 0) -> np.ndarray:
    """One row per gram, one column per language."""
    if level == ORDER:
        return np.broadcast_to(model.floor, (len(keys), len(model.languages)))
    table = model.levels[level]
    at, hit = _find(table.grams, keys)
    out = table.values[at]
    miss = np.flatnonzero(~hit)
    if len(miss):
        c, known = _find(table.contexts, keys[miss] >> np.uint64(16))
        shorter = log_probabilities(model, keys[miss] & _SUFFIX[ORDER - level - 1], level + 1)
        out[miss] = np.where(known[:, None], table.weights[c], 0) + shorter
    return out


def entropies(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bits per character of each text under each language, and the number of characters."""
    lines = [symbols(t) for t in texts]
    sizes = np.array([len(x) for x in lines])
    total = np.zeros((len(texts), len(model.languages)))
    group, held = [], 0
    for i, line in enumerate([*lines, None]):
        if line is None or held + len(line) > STEP_BYTES:
            if group:
                keys = np.concatenate([grams(lines[j]) for j in group])
                for a in range(0, len(keys), STEP_BYTES):
                    values = log_probabilities(model, keys[a : a + STEP_BYTES])
                    bounds = np.cumsum(sizes[group])
                    owner = np.searchsorted(bounds, np.arange(a, a + len(values)), "right")
                    cut = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                    np.add.at(total, np.array(group)[owner[cut]], np.add.reduceat(values, cut, axis=0, dtype=np.float64))
            group, held = [], 0
        if line is not None and len(line):
            group.append(i)
            held += len(line)
    return -total / np.maximum(sizes, 1)[:, None], sizes


PREDICTED_SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double, bits_per_char double, rejected boolean"


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            letters = batch.column("has_letter").to_numpy(zero_copy_only=False)
            text_column = batch.column("text")
            langs, scores, bits, rejected = [], [], [], []
            for texts in chunks(text_column):
                n = len(texts.offsets) - 1
                words = [x or "" for x in text_column.slice(texts.first, n).to_pylist()]
                h, sizes = entropies(model, words)
                best = np.argmin(h, axis=1)
                low = h[np.arange(n), best]
                code = np.exp2(-np.minimum(sizes, CODE_CHARACTERS)[:, None] * (h - low[:, None]))
                known = letters[texts.first : texts.first + n]
                langs += [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                scores.append(np.where(known, 1.0 / code.sum(axis=1), 0.0))
                bits.append(np.where(known, low, 0.0))
                limit = model.limits[best] if model.limits is not None else np.full(n, np.inf)
                rejected.append(~known.astype(bool) | ((low > limit) & (sizes >= REJECT_CHARACTERS)))
            join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(join(scores, float)), pa.array(join(bits, float)), pa.array(join(rejected, bool))],
                names=["doc_id", "held_out", "lang_pred", "score", "bits_per_char", "rejected"],
            )

    return run


def _rows(docs: DataFrame) -> DataFrame:
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "lang", held.alias("held_out"))


def train(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> Model | None:
    """Fit on at most sample_documents labelled documents per language, those with the smallest hash of their id.

    Held-out documents are never read.  The grams that come to the driver are those of the sample, so they are bounded by it.
    """
    rows = _rows(docs).where("NOT held_out AND doc_id IS NOT NULL AND lang IS NOT NULL")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = rows.select("doc_id", "lang").distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample_documents)
    apart = (F.pmod(F.xxhash64("text"), F.lit(CALIBRATION_EVERY)) == 0) & (F.col("place") > 1)  # each language has a document to learn from
    sample = rows.join(F.broadcast(picked), ["doc_id", "lang"]).select("doc_id", "lang", "text", "held_out", apart.alias("apart"))
    found = sample.where("NOT apart").select("lang", "text").mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs = np.array(found.column("lang").to_pylist(), object)
    keys, counts = found.column("gram").to_numpy().view(np.uint64), found.column("n").to_numpy()
    counted = {}
    for x in sorted(set(langs)):
        own = np.flatnonzero(langs == x)
        own = own[np.argsort(keys[own])]
        counted[x] = (keys[own], counts[own])
    if not counted:
        return None
    model = fit(counted)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = sample.where("apart").withColumn("has_letter", F.col("text").rlike(r"\p{L}")).drop("lang", "apart").mapInArrow(_predict(shared), PREDICTED_SCHEMA)
    measured = scored.where(F.col("lang_pred") != UNKNOWN).groupBy("lang_pred").agg(F.avg("bits_per_char"), F.stddev_pop("bits_per_char"), F.count("*"))
    limits = {lang: mean + REJECT_DEVIATIONS * spread for lang, mean, spread, n in measured.collect() if n >= CALIBRATION_LEAST}
    return model._replace(limits=np.array([limits.get(x, np.inf) for x in model.languages]))


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, bits_per_char, rejected."""
    rows = _rows(docs).drop("lang").withColumn("has_letter", F.col("text").rlike(r"\p{L}"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("bits_per_char"), F.lit(True).alias("rejected"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_predict(shared), PREDICTED_SCHEMA)
