"""Exact repeated passages by difference-cover suffix samples, one bucket of suffixes at a time.

A byte is removed when it lies in a string of WINDOW bytes that also starts anywhere else, in any text.  Suffixes
are sampled at the places of a difference cover modulo V (a perfect difference set, so 12 of 133 places, shifted at
random for every text).  For any two equal windows there is a shift below V at which both texts are sampled, and the
CORE = WINDOW - V + 1 bytes from there lie inside both windows.  So:

1. Samples are dealt to buckets by the hash of their core, and each bucket is sorted by (core, context), where the
   context is all that windows through the core can hold: V - 1 bytes before it and WINDOW bytes from its start.  The
   sorted runs are the ranks of the sample.  A sample alone with its core is done.  One whose whole context occurs
   twice proves all its windows.  The others, and one of each distinct context in their runs, go on.
2. Of these the context bytes are dealt by core, and ties are resolved window by window: equal windows at
   equal distance from the core are repeats.

Equal contexts of one run of documents are joined before the shuffle, so a passage in a third of all texts
sends one sample per run.  Windows of a core with more than GROUP_LIMIT different contexts are dealt by
their own hashes instead.  Hashes have 80 bits or more where they decide.

Texts are UTF-8 bytes, null is empty.  Rows that repeat others are repeats of them.  The input must be a scan of
stored rows, as a task that runs again must see them in the same order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replaykit.session import written_table

from .textbytes import chunks, mix, prefix_sums, span_hashes, string_buffers

WINDOW = 200
ORDER = 11
V = ORDER * ORDER + ORDER + 1
CORE = WINDOW - V + 1
PIECE = 1 << 20
UNIT_SAMPLES = 1 << 20
# above the place of a sample in its unit, 12 of 133 bytes of a text below 2**31 bytes
TWIN = 1 << 31
ENTRY_BYTES = 14
SAMPLES_PER_BUCKET = 700_000
GROUP_LIMIT = 4096
CONTEXTS_AT_ONCE = 2048  # whose windows a task holds at a time, and those of the last one's core
KEY_MASK = np.uint64((1 << 40) - 1)


def difference_set(q: int) -> np.ndarray:
    """q + 1 residues modulo q*q + q + 1 (q prime) whose differences meet every other residue exactly once.

    The powers of a suitable root of a cubic over the field of q elements run through all points of a plane; those
    on a line are the set.
    """
    n = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                point, line, seen = (1, 0, 0), [], set()
                for i in range(n):
                    lead = next(x for x in point if x)
                    scale = pow(lead, -1, q)
                    seen.add(tuple(x * scale % q for x in point))
                    if point[2] == 0:
                        line.append(i)
                    x, y, z = point
                    point = (z * c % q, (x + z * b) % q, (y + z * a) % q)
                if len(seen) == n:
                    return np.array(line)
    raise ValueError(f"{q} is not prime")


COVER = difference_set(ORDER)
_tile: dict[int, np.ndarray] = {}


def sampled(length: int, phase: int) -> np.ndarray:
    """Places of a text that are in the cover and have a whole core behind them."""
    last = length - CORE
    if last < 0:
        return np.zeros(0, np.int64)
    periods = (last + phase) // V + 1
    size = 1 << max(12, int(periods).bit_length())
    if size not in _tile:
        _tile[size] = (np.arange(size)[:, None] * V + COVER).ravel()
    tile = _tile[size]
    low, high = np.searchsorted(tile, phase), np.searchsorted(tile, last + phase, "right")
    return tile[low:high] - phase


def _hashes(data: np.ndarray, places: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Core and context hashes of sampled places, whose texts are data[starts:ends]."""
    core = np.empty(len(places), np.uint64)
    context = np.empty(len(places), np.uint64)
    at = 0
    while at < len(places):
        stop = max(at + 1, int(np.searchsorted(places, places[at] + PIECE)))
        p, s, e = places[at:stop], starts[at:stop], ends[at:stop]
        low = max(int(p[0]) - V + 1, 0)
        sums = prefix_sums(data[low : int(p[-1]) + WINDOW])
        left, right = np.maximum(p - V + 1, s), np.minimum(p + WINDOW, e)
        core[at:stop] = mix(span_hashes(sums, p - low, p + CORE - low))
        shape = ((p - left) * 512 + (right - p)).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
        context[at:stop] = mix(mix(span_hashes(sums, left - low, right - low)) + shape)
        at = stop
    return core, context


PACKED_SCHEMA = "bucket bigint, unit bigint, entries binary, docs binary, proven binary"


def _sample(buckets: int):
    """Packed samples: for every unit of documents one row per bucket, and one row that names its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            digests = batch.column("digest").to_numpy(zero_copy_only=False)
            nulls = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            phases = batch.column("phase").to_numpy(zero_copy_only=False)
            for texts in chunks(batch.column("text")):
                per_doc = [sampled(int(n), int(f)) for n, f in zip(np.diff(texts.offsets), phases[texts.first :])]
                counts = np.array([len(x) for x in per_doc])
                starts = np.repeat(texts.offsets[:-1], counts)
                places = np.concatenate(per_doc) + starts
                core, context = _hashes(texts.data, places, starts, np.repeat(texts.offsets[1:], counts))
                rows = slice(texts.first, texts.first + len(counts))
                held.append((core, context, ids[rows], digests[rows], nulls[rows], counts))
                size += len(core)
                if size >= UNIT_SAMPLES:
                    yield _packed(held, buckets)
                    held, size = [], 0
        if held:
            yield _packed(held, buckets)

    return run


def _packed(held: list[tuple], buckets: int) -> pa.RecordBatch:
    core, context, ids, digests, nulls, counts = (np.concatenate(x) for x in zip(*held, strict=True))
    unit = int.from_bytes(hashlib.sha256(ids.tobytes() + digests.tobytes() + core[:64].tobytes()).digest()[:8], "little", signed=True)
    # equal contexts within the unit: one stands for all, the others are proven here
    order = np.lexsort((context, core))
    same = np.zeros(len(order), bool)
    if len(order):
        same[1:] = (core[order][1:] == core[order][:-1]) & (context[order][1:] == context[order][:-1])
    twins = np.zeros(len(order), bool)
    twins[:-1] = same[1:]
    sent, twin = order[~same], twins[~same]
    proven = np.sort(order[same]).astype(np.uint32)
    key = core[sent]
    bucket = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)  # ascending, as the keys are
    entries = np.zeros((len(sent), ENTRY_BYTES), np.uint8)
    entries[:, 0:5] = (key & KEY_MASK).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    entries[:, 5:10] = context[sent].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    entries[:, 10:14] = (sent + twin * TWIN).astype("<u4").view(np.uint8).reshape(-1, 4)
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(bucket)) if len(bucket) else starts
    n = len(starts)
    doc_rows = np.zeros(len(ids), dtype=DOC_ROW)
    doc_rows["id"], doc_rows["digest"], doc_rows["null"], doc_rows["n"] = ids, digests, nulls, counts
    return pa.RecordBatch.from_arrays(
        [
            pa.array([*bucket[starts].astype(np.int64).tolist(), -1 - (unit & 0xFFFFFFFF)], pa.int64()),
            pa.array([unit] * (n + 1), pa.int64()),
            pa.array([*[entries[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], None], pa.binary()),
            pa.array([None] * n + [doc_rows.tobytes()], pa.binary()),
            pa.array([None] * n + [proven.tobytes()], pa.binary()),
        ],
        names=["bucket", "unit", "entries", "docs", "proven"],
    )


DOC_ROW = np.dtype([("id", "<i8"), ("digest", "<i8"), ("n", "<u4"), ("null", "u1")])
RANKED_SCHEMA = "unit bigint, docs binary, proven binary, shown binary"


def _wide(raw: np.ndarray, low: int, high: int) -> np.ndarray:
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, : high - low] = raw[:, low:high]
    return out.view("<u8").ravel()


def _rank(rows: pd.DataFrame) -> pd.DataFrame:
    """Sort one bucket; per unit the samples whose context is repeated, and those whose context must be looked at."""
    named = rows[rows["docs"].notna()]
    out = [(u, d, p, None) for u, d, p in zip(named["unit"], named["docs"], named["proven"], strict=True)]
    rows = rows[rows["entries"].notna()]
    raw = np.frombuffer(b"".join(rows["entries"]), np.uint8).reshape(-1, ENTRY_BYTES)
    units = np.repeat(np.arange(len(rows)), [len(e) // ENTRY_BYTES for e in rows["entries"]])
    key = _wide(raw, 0, 5)
    twin = (raw[:, 13] & 0x80) > 0
    order = np.argsort(key)
    near = np.zeros(len(order), bool)
    equal = key[order][1:] == key[order][:-1]
    near[1:] |= equal
    near[:-1] |= equal
    several = order[near | twin[order]]
    raw, units, key, twin = raw[several], units[several], key[several], twin[several]
    context = _wide(raw, 5, 10)
    order = np.lexsort((context, key))
    raw, units, key, twin, context = raw[order], units[order], key[order], twin[order], context[order]
    if len(key):
        first_key = np.concatenate(([True], key[1:] != key[:-1]))
        first = first_key | np.concatenate(([True], context[1:] != context[:-1]))
        run, group = np.cumsum(first) - 1, np.cumsum(first_key) - 1
        held = np.bincount(run, 1 + twin)
        contexts = np.bincount(group[first])
        proven = held[run] >= 2
        lone = np.zeros(len(contexts), bool)
        lone[group[first][held < 2]] = True
        shown = first & (contexts[group] >= 2) & lone[group]
        place = (_wide(raw, 10, 14) & np.uint64(TWIN - 1)).astype(np.uint32)
        names = rows["unit"].to_numpy()
        by = np.argsort(units, kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], units[by][1:] != units[by][:-1])))
        for a, b in zip(cuts, np.append(cuts[1:], len(by)), strict=True):
            mine = by[a:b]
            out.append((names[units[mine[0]]], None, place[mine[proven[mine]]].tobytes(), place[mine[shown[mine]]].tobytes()))
    return pd.DataFrame(out, columns=["unit", "docs", "proven", "shown"])


MARKED_SCHEMA = "doc_id bigint, digest bigint, proven binary, shown binary"


def _by_document(rows: pd.DataFrame) -> pd.DataFrame:
    """Marked samples of one unit as ordinals of samples within each document."""
    docs = np.frombuffer(b"".join(x for x in rows["docs"] if x is not None), DOC_ROW)
    bounds = np.concatenate(([0], np.cumsum(docs["n"].astype(np.int64))))
    found = {}
    for c in ("proven", "shown"):
        every = np.sort(np.frombuffer(b"".join(x for x in rows[c] if x is not None), np.uint32))
        found[c] = (every, np.searchsorted(every, bounds))
    marked = np.flatnonzero((np.diff(found["proven"][1]) > 0) | (np.diff(found["shown"][1]) > 0))
    out = []
    for i in marked.tolist():
        parts = [(e[at[i] : at[i + 1]] - bounds[i]).astype(np.uint32).tobytes() for e, at in found.values()]
        out.append((None if docs["null"][i] else int(docs["id"][i]), int(docs["digest"][i]), *parts))
    return pd.DataFrame(out, columns=["doc_id", "digest", "proven", "shown"]).astype({"doc_id": "Int64", "digest": "int64"})


CONTEXT_SCHEMA = "core bigint, doc_id bigint, digest bigint, low bigint, lead int, context binary"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The context bytes of the samples that must be looked at."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = ["core", "doc_id", "digest", "low", "lead", "context"]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            ordinals = np.frombuffer(batch.column("shown")[i].as_py() or b"", np.uint32)
            if not len(ordinals):
                continue
            data, _ = string_buffers(batch.column("text").slice(i, 1))
            places = sampled(len(data), batch.column("phase")[i].as_py())[np.sort(ordinals)]
            core, _ = _hashes(data, places, np.zeros(len(places), np.int64), np.full(len(places), len(data)))
            doc, digest, raw = batch.column("doc_id")[i].as_py(), batch.column("digest")[i].as_py(), data.tobytes()
            for p, c in zip(places.tolist(), core.view(np.int64).tolist(), strict=True):
                low = max(p - V + 1, 0)
                rows.append((c, doc, digest, low, p - low, raw[low : p + WINDOW]))
                if len(rows) >= CONTEXTS_AT_ONCE:
                    yield packed(rows)
                    rows = []
        if rows:
            yield packed(rows)


RUN_SCHEMA = "doc_id bigint, digest bigint, first bigint, last bigint"


def _windows(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every window of the contexts: row, start within the text, hash of core, distance and bytes."""
    sizes = np.array([len(c) for c in rows["context"]])
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    lead = rows["lead"].to_numpy().astype(np.int64)
    counts = np.maximum(np.minimum(lead, sizes - WINDOW) + 1, 0)
    row = np.repeat(np.arange(len(rows)), counts)
    start = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = bounds[row] + start
    data = np.frombuffer(b"".join(rows["context"]), np.uint8)
    whole = np.empty(len(at), np.uint64)
    done = 0
    while done < len(at):
        stop = max(done + 1, int(np.searchsorted(at, at[done] + PIECE)))
        base = int(at[done])
        sums = prefix_sums(data[base : int(at[stop - 1]) + WINDOW])
        whole[done:stop] = span_hashes(sums, at[done:stop] - base, at[done:stop] + WINDOW - base)
        done = stop
    distance = (lead[row] - start).astype(np.uint64)
    core = rows["core"].to_numpy().view(np.uint64)[row]
    return row, rows["low"].to_numpy()[row] + start, mix(mix(whole) + mix(core + distance * np.uint64(0xD6E8FEB86659FD93)))


def _repeated(values: np.ndarray) -> np.ndarray:
    order = np.argsort(values)
    same = values[order][1:] == values[order][:-1]
    out = np.zeros(len(values), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def _runs(rows: pd.DataFrame, row: np.ndarray, start: np.ndarray) -> pd.DataFrame:
    """Maximal runs of starts within each row, which come ascending."""
    if not len(row):
        return pd.DataFrame({"doc_id": pd.array([], "Int64"), "digest": np.zeros(0, np.int64), "first": np.zeros(0, np.int64), "last": np.zeros(0, np.int64)})
    cut = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1))))
    end = np.append(cut[1:], len(row)) - 1
    return pd.DataFrame({
        "doc_id": rows["doc_id"].astype("Int64").array[row[cut]], "digest": rows["digest"].to_numpy()[row[cut]],
        "first": start[cut], "last": start[end],
    })


def _resolve(rows: pd.DataFrame) -> pd.DataFrame:
    """Repeated windows among the contexts of a bucket of cores.

    A window's value is made of its core too, so whole cores are looked at in turn, however many contexts the bucket holds.
    """
    rows = rows.sort_values("core", kind="stable", ignore_index=True)
    out = []
    for low, high in _slices(rows["core"].to_numpy()):
        part = rows.iloc[low:high].reset_index(drop=True)
        row, start, value = _windows(part)
        hit = _repeated(value)
        out.append(_runs(part, row[hit], start[hit]))
    return pd.concat(out, ignore_index=True)


def _slices(core: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of about CONTEXTS_AT_ONCE sorted rows that part no core."""
    starts = np.flatnonzero(np.concatenate(([True], core[1:] != core[:-1])))
    kept = starts[np.concatenate(([True], np.diff(starts // CONTEXTS_AT_ONCE) > 0))]
    return list(zip(kept.tolist(), np.append(kept[1:], len(core)).tolist(), strict=True))


def _scatter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Windows of crowded cores, one row each."""
    for batch in batches:
        for low in range(0, len(batch), CONTEXTS_AT_ONCE):
            rows = batch.iloc[low : low + CONTEXTS_AT_ONCE].reset_index(drop=True)
            row, start, value = _windows(rows)
            yield pd.DataFrame({
                "value": value.view(np.int64), "doc_id": rows["doc_id"].astype("Int64").array[row], "digest": rows["digest"].to_numpy()[row], "first": start,
            })


CUT_SCHEMA = "doc_id bigint, digest bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"


def spans(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Maximal byte runs covered by windows that start in [first, last]."""
    out: list[list[int]] = []
    for i in np.argsort(first, kind="stable").tolist():
        low, high = int(first[i]), int(last[i]) + WINDOW
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


def _cut(want_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                data, _ = string_buffers(batch.column("text").slice(i, 1))
                raw, n = data.tobytes(), len(data)
                proven = sampled(n, batch.column("phase")[i].as_py())[np.frombuffer(batch.column("proven")[i].as_py() or b"", np.uint32)]
                more = batch.column("runs")[i].as_py() or []
                first = np.concatenate((np.maximum(proven - V + 1, 0), [r["first"] for r in more])).astype(np.int64)
                last = np.concatenate((np.minimum(proven, n - WINDOW), [r["last"] for r in more])).astype(np.int64)
                sound = last >= first
                gone = spans(first[sound], last[sound])
                edges = [0, *[x for span in gone for x in span], n]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                text = kept.decode("utf-8", "ignore") if want_text else None
                out.append((batch.column("doc_id")[i].as_py(), batch.column("digest")[i].as_py(), n, n - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), text))
            types = [pa.int64()] * 5 + [pa.string()] * 2
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "digest", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text with the digest that tells apart texts of one doc_id, and the phase of the cover."""
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), digest.alias("digest")).withColumn(
        "phase", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(V)).cast("int")
    )


def cuts(docs: DataFrame, want_text: bool = False) -> DataFrame:
    """For each distinct (doc_id, digest) with a marked sample: sizes, spans, digest and (on demand) text of what is kept.

    Bytes of a character that a removed run cuts through are left out of the text.
    """
    source = keyed(docs)
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, int(size * len(COVER) / V / SAMPLES_PER_BUCKET))
    packed = source.mapInArrow(_sample(buckets), PACKED_SCHEMA)
    ranked = written_table(packed.groupBy("bucket").applyInPandas(_rank, RANKED_SCHEMA), "suffix-ranks")
    by_document = ranked.groupBy("unit").applyInPandas(_by_document, MARKED_SCHEMA)
    merged = by_document.groupBy("doc_id", "digest").agg(F.array_join(F.collect_list(F.hex("proven")), "").alias("p"), F.array_join(F.collect_set(F.hex("shown")), "").alias("s"))
    marked = merged.select(F.col("doc_id").alias("m_id"), F.col("digest").alias("m_digest"), F.unhex("p").alias("proven"), F.unhex("s").alias("shown"))
    same = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("digest") == F.col("m_digest"))
    one_each = source.join(marked, same).drop("m_id", "m_digest")
    open_docs = written_table(one_each.dropDuplicates(["doc_id", "digest"]), "suffix-texts")
    contexts = open_docs.where("length(shown) > 0").mapInArrow(_contexts, CONTEXT_SCHEMA)
    # contexts are made twice rather than stored: they are many times the texts that they come from
    crowded = written_table(contexts.groupBy("core").count().where(F.col("count") > GROUP_LIMIT).select("core"), "suffix-crowded")
    few = contexts
    if crowded.limit(1).count():
        few = contexts.join(crowded, "core", "left_anti")
    dealt = few.withColumn("deal", F.pmod(F.xxhash64("core"), F.lit(buckets * 4)))
    runs = dealt.groupBy("deal").applyInPandas(_resolve, RUN_SCHEMA)
    if few is not contexts:
        scattered = contexts.join(crowded, "core", "left_semi").mapInPandas(_scatter, "value bigint, doc_id bigint, digest bigint, first bigint")
        twice = scattered.groupBy("value").agg(F.count("*").alias("n")).where("n > 1").select("value")
        runs = runs.unionByName(scattered.join(twice, "value").select("doc_id", "digest", "first", F.col("first").alias("last")))
    gathered = runs.groupBy("doc_id", "digest").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    gathered = gathered.select(F.col("doc_id").alias("m_id"), F.col("digest").alias("m_digest"), "runs")
    return open_docs.drop("shown").join(gathered, same, "left").drop("m_id", "m_digest").mapInArrow(_cut(want_text), CUT_SCHEMA)


def removals(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    found = written_table(cuts(docs).where("n_removed > 0").drop("kept"), "suffix-cuts")
    found = found.select(*[F.col(c).alias(f"m_{c}") for c in ("doc_id", "digest", "n_removed", "n_spans", "kept_sha256")])
    rows = keyed(docs).select("doc_id", "digest", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("m_doc_id")) & (F.col("digest") == F.col("m_digest")), "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "doc_id", "n_bytes", F.coalesce("m_n_removed", zero).alias("n_removed"), F.coalesce("m_n_spans", zero).alias("n_spans"),
        F.coalesce("m_kept_sha256", "sha").alias("kept_sha256"),
    )
