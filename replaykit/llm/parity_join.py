"""N-gram Jaccard self-join by parity sketches.

A document is its set of distinct five-word shingles.  Every shingle flips bits of one block of a sketch (the block's
64-bit word is the XOR of the shingles' hashes), so the number of blocks in which two sketches differ is at most the
symmetric difference of the sets.  Sets of sizes a <= b with Jaccard similarity 3/4 or more differ in at most
(a + b) / 7 shingles.  Sizes form bands [2^t, 2^(t+1)) with a sketch width for each; a document takes part in its own
band and, where a smaller document may be its partner, in the band below.  With k the bound, at most k of a document's
filled blocks differ from a partner's, so under any fixed order of (block, word) pairs the first k + 1 filled blocks
of both share the first pair that they have in common.  Only these are joined.  Blocks with many shingles come first: they say most.
Blocks that a first count finds crowded (a passage that many documents quote) come last, marked in a table of fixed size; so only
documents that consist of such blocks, as near copies do, still meet in them.
Bands of fewer than 32 shingles give each shingle a block of its own.  If a document fills fewer than k + 1
blocks, all sketches of the run are made wider.

Equal sets form a class first and take part once.  Candidates are filtered on a second sketch of single bits,
four or more for each shingle, whose Hamming distance is such a lower bound too; the sketch of a larger set is folded
to the width of the other.  What passes is verified on the sets of whole texts.
In a block of more than ``ALL_PAIRS`` classes each is first paired with three of them only; what is still unconnected
then is compared on the single bits in blocks of rows.  The join gives components, and these are whole; it does not give links: inside a
block of more than ``ALL_PAIRS`` classes most links between members of one component are neither found nor verified.

Null and empty texts have no shingles and link with nothing.  Rows repeating a doc_id are judged by their own text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replaykit.session import written_table

from .components import components
from .textbytes import ASCII_LOWER, Texts, chunks, mix, string_buffers, word_hashes

WORDS = 5
ELEMENT_BAND = 5  # below 2**5 shingles
SHINGLES_PER_BLOCK = (0.75, 1.5)  # in bands below and from 2**8
LEAST_BITS = 512
BITS_PER_SHINGLE = 4
ALL_PAIRS = 32
CELL = 64
COMPARE_BLOCK = 512
KEYS_PER_BUCKET = 500_000
FLUSH_KEYS = 1_000_000
LATE_BITS = 23
KEY_MASK = np.uint64((1 << 40) - 1)
_WEIGHTS = mix(np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(texts: Texts) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, first = word_hashes(texts._replace(data=ASCII_LOWER[texts.data]))
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
        for j in range(WORDS):
            rolled += words[j : j + len(rolled)] * _WEIGHTS[j]
        rolled = mix(rolled)
        for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if high - low >= WORDS:
                yield np.unique(rolled[low : high - WORDS + 1])
            elif high > low:
                short = (words[low:high] * _WEIGHTS[: high - low]).sum(dtype=np.uint64)
                yield mix(np.array([short + np.uint64(high - low)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that stand for the set."""
    salted = mix(shingles ^ np.uint64(0xA0761D6478BD642F))
    return int(salted.sum(dtype=np.uint64).astype(np.int64)), int(mix(salted).sum(dtype=np.uint64).astype(np.int64))


def parity_bits(shingles: np.ndarray) -> bytes:
    width = max(LEAST_BITS, BITS_PER_SHINGLE << max(len(shingles) - 1, 0).bit_length())
    ones = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(ones.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, n_bytes: int) -> np.ndarray:
    """The sketch at a smaller width: places that become one add up modulo 2."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint64).reshape(-1, n_bytes // 8), axis=0)


def bands(n: int) -> list[tuple[int, int]]:
    """The bands in which a set of n shingles takes part, with its bound on differing blocks in each."""
    own = n.bit_length() - 1
    out = [(own, n // 3)]  # partners of up to 4n/3
    below = (1 << own) - 1
    if 3 * n <= 4 * below:
        out.append((own - 1, (n + below) // 7))
    return out


def places(keys: np.ndarray) -> np.ndarray:
    """Places of keys in the table of crowded ones, from bits that a bucket still knows."""
    return (keys & KEY_MASK) >> np.uint64(40 - LATE_BITS)


def block_keys(shingles: np.ndarray, band: int, bound: int, wider: int, late: np.ndarray | None = None) -> np.ndarray | None:
    """The keys of the first bound + 1 filled blocks; None if fewer are filled.

    Keys whose place is marked in ``late`` come after all others.
    """
    salt = np.uint64((band + 1) * 0x2545F4914F6CDD1D % (1 << 64))
    if band < ELEMENT_BAND or wider > 3:
        keys, held = mix(shingles ^ salt), None
    else:
        per_block = SHINGLES_PER_BLOCK[band >= 8] / 2**wider
        width = np.uint64(int((2 << band) / per_block) + 1)
        block = ((shingles >> np.uint64(32)) * width) >> np.uint64(32)  # ascending, as the shingles are
        starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        held = np.diff(starts, append=len(shingles))
        words = np.bitwise_xor.reduceat(mix(shingles ^ np.uint64(0x8EBC6AF09C88C6E3)), starts)
        keys = mix(words ^ (block[starts] * np.uint64(0x589965CC75374CC3)) ^ salt)
    if len(keys) <= bound:
        return None
    if len(keys) == bound + 1:
        return keys
    rank = keys >> np.uint64(6)
    if held is not None:
        rank |= (np.uint64(31) - np.minimum(held, 31).astype(np.uint64)) << np.uint64(58)
    if late is not None:
        rank |= late[places(keys)].astype(np.uint64) << np.uint64(63)
    return keys[rank <= np.partition(rank, bound)[bound]]


DOC_SCHEMA = "doc_id bigint, text_digest bigint, n bigint, fp1 bigint, fp2 bigint, wider int, parity binary"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("text_digest", pa.int64()), ("n", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("wider", pa.int32()), ("parity", pa.binary())])
    for batch in batches:
        rows: list[tuple] = []
        for texts in chunks(batch.column("text")):
            for s in shingle_sets(texts):
                wider = 0
                if len(s):
                    while any(block_keys(s, band, bound, wider) is None for band, bound in bands(len(s))):
                        wider += 1
                rows.append((len(s), *set_digest(s), wider, parity_bits(s)))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_digest"), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[2:], strict=True)]], schema=schema)


def _emit(wider: int, buckets: int, late: bytes | None = None):
    marks = None if late is None else np.frombuffer(late, np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        table = None if marks is None else np.unpackbits(marks, bitorder="little")
        for batch in batches:
            for texts in chunks(batch.column("text")):
                seen = set()
                for s in shingle_sets(texts):
                    if not len(s):
                        continue
                    owner = set_digest(s)[0]
                    if owner in seen:
                        continue
                    seen.add(owner)
                    for band, bound in bands(len(s)):
                        keys = block_keys(s, band, bound, wider, table)
                        held.append((keys, np.full(len(keys), owner, np.int64)))
                        size += len(keys)
                if size >= FLUSH_KEYS:
                    yield _packed(held, buckets)
                    held, size = [], 0
        if held:
            yield _packed(held, buckets)

    return run


PACKED_SCHEMA = "bucket bigint, keys binary, owners binary"


def _packed(held: list[tuple[np.ndarray, np.ndarray]], buckets: int) -> pa.RecordBatch:
    """Keys by bucket, five bytes each, beside their owners: one row per bucket."""
    keys = np.concatenate([k for k, _ in held])
    owners = np.concatenate([o for _, o in held])
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    keys, owners, bucket = keys[order], owners[order], bucket[order]
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    ends = np.append(starts[1:], len(keys))
    short = (keys & KEY_MASK).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[starts].astype(np.int64)),
            pa.array([short[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
            pa.array([owners[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
        ],
        names=["bucket", "keys", "owners"],
    )


def _members(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys with their distinct owners, and where each key starts."""
    short = np.frombuffer(b"".join(rows["keys"]), np.uint8).reshape(-1, 5)
    wide = np.zeros((len(short), 8), np.uint8)
    wide[:, :5] = short
    keys = wide.view("<u8").ravel()
    owners = np.frombuffer(b"".join(rows["owners"]), np.int64)
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    fresh = np.concatenate(([True], (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])))
    keys, owners = keys[fresh], owners[fresh]
    return keys, owners, np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))


def _crowded(rows: pd.DataFrame) -> pd.DataFrame:
    """Places of keys with more than ALL_PAIRS owners, as bits of 64-bit words."""
    keys, _, starts = _members(rows)
    place = np.unique(places(keys[starts[np.diff(starts, append=len(keys)) > ALL_PAIRS]]))
    word, bit = (place >> np.uint64(6)).astype(np.int32), np.uint64(1) << (place & np.uint64(63))
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))) if len(word) else np.zeros(0, np.int64)
    return pd.DataFrame({"word": word[first], "mask": (np.bitwise_or.reduceat(bit, first) if len(first) else bit).astype(np.int64)})


def crowded_keys(packed: DataFrame) -> bytes:
    """The table of crowded keys, a bit for each of 2 ** LATE_BITS places; at most one row per word of it reaches the driver."""
    words = np.zeros(1 << (LATE_BITS - 6), np.int64)
    marked = packed.groupBy("bucket").applyInPandas(_crowded, "word int, mask bigint")
    for word, mask in marked.groupBy("word").agg(F.bit_or("mask")).collect():
        words[word] = mask
    return words.tobytes()


MET_SCHEMA = "kind int, a bigint, b bigint"


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs of owners that share a key; of a key with many owners, its members and their pairs with three of them."""
    keys, owners, starts = _members(rows)
    sizes = np.diff(starts, append=len(keys))
    out_a, out_b, members = [], [], {}
    for size in np.unique(sizes[sizes > 1]).tolist():
        at = starts[sizes == size]
        if size <= ALL_PAIRS:
            i, j = np.triu_indices(size, 1)
            out_a.append(owners[at[:, None] + i].ravel())
            out_b.append(owners[at[:, None] + j].ravel())
            continue
        for s in at.tolist():
            group = owners[s : s + size]
            for hub in range(3):  # the least owners, so that keys with the same members have the same hubs
                rest = np.delete(group, hub)
                out_a.append(np.minimum(rest, group[hub]))
                out_b.append(np.maximum(rest, group[hub]))
            members.setdefault(int(group[0]), []).append(group)
    pairs = np.unique(np.stack([np.concatenate(out_a), np.concatenate(out_b)], 1), axis=0) if out_a else np.zeros((0, 2), np.int64)
    parts = [pd.DataFrame({"kind": np.int32(0), "a": pairs[:, 0], "b": pairs[:, 1]})]
    # keys with the same least owner make one group, so near copies, which share many keys, are listed once
    parts += [pd.DataFrame({"kind": np.int32(1), "a": hub, "b": np.unique(np.concatenate(groups))}) for hub, groups in members.items()]
    return pd.concat(parts, ignore_index=True)


def _verify(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between the hub of a cell and its other members, on the sets of the whole texts."""
    column = pa.array(rows["text"], pa.large_string())
    sets = [s for texts in chunks(column) for s in shingle_sets(texts)]
    sound = [len(s) > 0 and set_digest(s)[0] == fp for s, fp in zip(sets, rows["fp1"], strict=True)]
    hub_rows = [i for i in range(len(rows)) if sound[i] and rows["hub"].iat[i]]
    links = []
    for i in hub_rows[:1]:
        for j in range(len(rows)):
            if sound[j] and not rows["hub"].iat[j]:
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                    links.append((rows["cell_a"].iat[i], rows["id"].iat[j]))
    return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of pairs (a, fa, b, fb) of representatives the true links (a, b).

    The partners of a are dealt over cells of about CELL texts.
    """
    degree = pairs.groupBy("a").agg((1 + F.floor(F.count("*") / CELL)).alias("cells"))
    dealt = pairs.join(degree, "a").withColumn("cell", F.pmod(F.xxhash64("b"), F.col("cells")))
    hubs = dealt.select(F.col("a").alias("id"), F.col("fa").alias("fp1"), F.col("a").alias("cell_a"), "cell", F.lit(True).alias("hub")).distinct()
    others = dealt.select(F.col("b").alias("id"), F.col("fb").alias("fp1"), F.col("a").alias("cell_a"), "cell", F.lit(False).alias("hub"))
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    wanted = hubs.unionByName(others).join(texts, "id")
    return wanted.groupBy("cell_a", "cell").applyInPandas(_verify, "a bigint, b bigint")


def _near_enough(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs whose single bits differ in no more places than their sets may."""
    for rows in batches:
        widths = [min(len(x), len(y)) for x, y in zip(rows["pa"], rows["pb"], strict=True)]
        apart = np.array([int(np.bitwise_count(folded(x, w) ^ folded(y, w)).sum()) for x, y, w in zip(rows["pa"], rows["pb"], widths, strict=True)], np.int64)
        fits = apart <= (rows["na"].to_numpy() + rows["nb"].to_numpy()) // 7
        yield rows.loc[fits, ["a", "fa", "b", "fb"]]


def _sketched(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, fa, na, b, fb, nb) of representatives that their parity bits allow."""
    bits = classes.select("rep", "parity")
    both = pairs.join(bits.withColumnsRenamed({"rep": "a", "parity": "pa"}), "a").join(bits.withColumnsRenamed({"rep": "b", "parity": "pb"}), "b")
    return both.mapInPandas(_near_enough, "a bigint, fa bigint, b bigint, fb bigint")


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs of members of different components, one of each side, that size and parity bits allow."""
    width = min(map(len, rows["parity"]))
    bits = np.stack([folded(x, width) for x in rows["parity"]])
    n, root, side, ids, fps = (rows[c].to_numpy() for c in ("n", "root", "side", "id", "fp1"))
    few, many = sorted((np.flatnonzero(side == 0), np.flatnonzero(side == 1)), key=len)
    out = []
    for x in few.tolist():
        other = many[(root[many] != root[x]) & (4 * np.minimum(n[many], n[x]) >= 3 * np.maximum(n[many], n[x]))]
        apart = np.bitwise_count(bits[other] ^ bits[x]).sum(axis=1)
        out += [(ids[x], fps[x], ids[y], fps[y]) for y in other[apart <= (n[x] + n[other]) // 7].tolist()]
    return pd.DataFrame(out, columns=["a", "fa", "b", "fb"], dtype=np.int64)


def _unconnected(members: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """Candidate pairs of large groups whose members are not all connected yet.

    Only members outside a group's largest component have pairs left.  Members are dealt over blocks of about COMPARE_BLOCK; those
    outside go to every block, so rows grow with the members and with what is still apart, not with the square of the group.
    """
    known = members.join(classes.select(F.col("fp1"), F.col("rep").alias("id"), "n", "parity"), "fp1")
    placed = known.join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id")).drop("node")
    per_root = placed.groupBy("gid", "root").agg(F.count("*").alias("size"))
    shape = per_root.groupBy("gid").agg(F.max(F.struct("size", "root")).alias("most"), F.count("*").alias("roots"), F.sum("size").alias("size"))
    shape = shape.where("roots > 1").select("gid", F.col("most.root").alias("main"), (1 + F.floor(F.col("size") / COMPARE_BLOCK)).cast("int").alias("blocks"))
    left = placed.join(shape, "gid")
    dealt = left.select("gid", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("side"), "id", "fp1", "n", "root", "parity")
    apart = left.where("root <> main").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = apart.select("gid", "block", F.lit(0).alias("side"), "id", "fp1", "n", "root", "parity")
    found = dealt.unionByName(sent).groupBy("gid", "block").applyInPandas(_compare, "a bigint, fa bigint, b bigint, fb bigint")
    swap = F.col("a") > F.col("b")
    return found.select(
        F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("fb")).otherwise(F.col("fa")).alias("fa"),
        F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"), F.when(swap, F.col("fa")).otherwise(F.col("fb")).alias("fb"),
    ).distinct()


def text_digest(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, ``representative`` (smallest doc_id with the same set), and text_digest."""
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), text_digest(text).alias("text_digest"))
    described = written_table(docs.mapInArrow(_describe, DOC_SCHEMA), "shingle-sets")
    total, wider = described.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("wider"), F.lit(0))).first()
    buckets = max(1, int(total * 0.5 / KEYS_PER_BUCKET))
    late = crowded_keys(docs.mapInArrow(_emit(wider, buckets), PACKED_SCHEMA))
    packed = docs.mapInArrow(_emit(wider, buckets, late), PACKED_SCHEMA)
    met = written_table(packed.groupBy("bucket").applyInPandas(_meet, MET_SCHEMA), "sketch-matches")

    classes = described.where("n > 0").groupBy("n", "fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.any_value("parity").alias("parity"))
    slim = classes.select("fp1", "n", "rep")
    left = slim.select(F.col("fp1").alias("a"), F.col("n").alias("na"), F.col("rep").alias("ra"))
    right = slim.select(F.col("fp1").alias("b"), F.col("n").alias("nb"), F.col("rep").alias("rb"))
    pairs = met.where("kind = 0").select("a", "b").distinct().join(left, "a").join(right, "b")
    pairs = pairs.where("4 * least(na, nb) >= 3 * greatest(na, nb) AND ra <> rb")
    swap = F.col("ra") > F.col("rb")
    pairs = pairs.select(
        F.least("ra", "rb").alias("a"), F.when(swap, F.col("b")).otherwise(F.col("a")).alias("fa"),
        F.greatest("ra", "rb").alias("b"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("fb"), "na", "nb",
    )
    candidates = written_table(_sketched(pairs, classes), "near-pairs")
    links = written_table(_verified(docs, candidates), "near-links")
    roots = components(links)
    members = met.where("kind = 1").select(F.col("a").alias("gid"), F.col("b").alias("fp1")).distinct()
    if members.limit(1).count():
        rest = written_table(_unconnected(members, classes, roots), "near-candidates")
        if rest.limit(1).count():
            roots = components(links.unionByName(_verified(docs, rest)))
    placed = classes.drop("parity").join(roots, F.col("rep") == F.col("node"), "left")
    placed = placed.select("n", "fp1", "fp2", F.col("rep").alias("representative"), F.coalesce("root", "rep").alias("component_id"))
    full = described.where("n > 0").join(placed, ["n", "fp1", "fp2"])
    empty = described.where("n = 0").withColumn("representative", F.col("doc_id")).withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id", "representative", "text_digest"]
    return full.select(*columns).unionByName(empty.select(*columns))
