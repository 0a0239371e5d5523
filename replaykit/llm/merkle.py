"""Document fingerprints: a Merkle tree over the pieces, paragraphs and sections of a text.

A text splits into paragraphs at ``\\n``, a paragraph into pieces of 64 code points, and eight
paragraphs make a section.  The digest of a piece is SHA-256 of its bytes; every other node digests its
children.  The fingerprint is ``root:sections:pieces``: the root decides equality, section and piece
digests (shortened) locate edits and measure likeness.  DataFrame functions only.

Null text counts as empty.  Every row is fingerprinted by itself, so ties and repeated rows need no rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replaykit.session import written_table

PIECE = 64
PARAGRAPHS_PER_SECTION = 8
SECTION_DIGITS = 12
PIECE_DIGITS = 6
ID_BITS_PER_LEVEL = 16
BLOCK_BITS = 10


def fingerprints(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the fingerprint of a text column."""
    paragraphs = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    nodes = F.transform(
        paragraphs, lambda p: F.transform(F.regexp_extract_all(p, F.lit(rf"((?s).{{1,{PIECE}}})"), F.lit(1)), lambda x: F.sha2(x, 256))
    )
    sections = F.transform(
        F.sequence(F.lit(0), (F.size("_nodes") - 1).cast("int"), F.lit(PARAGRAPHS_PER_SECTION)),
        lambda i: F.sha2(
            F.array_join(F.transform(F.slice("_nodes", i + 1, PARAGRAPHS_PER_SECTION), lambda p: F.sha2(F.array_join(p, ""), 256)), ""), 256
        ),
    )
    pieces = F.array_join(F.transform(F.flatten("_nodes"), lambda x: F.substring(x, 1, PIECE_DIGITS)), "")
    shown = F.array_join(F.transform("_sections", lambda x: F.substring(x, 1, SECTION_DIGITS)), "")
    root = F.sha2(F.array_join("_sections", ""), 256)
    return (
        df.withColumn("_nodes", nodes)
        .withColumn("_sections", sections)
        .withColumn(out, F.concat_ws(":", root, shown, pieces))
        .drop("_nodes", "_sections")
    )


def root(fingerprint: str) -> Column:
    return F.split_part(F.col(fingerprint), F.lit(":"), F.lit(1))


def _digests(fingerprint: str, level: int, digits: int) -> Column:
    return F.regexp_extract_all(F.split_part(F.col(fingerprint), F.lit(":"), F.lit(level)), F.lit(rf"([0-9a-f]{{{digits}}})"), F.lit(1))


def likeness(left: str, right: str) -> Column:
    """Share of distinct pieces in common, 2|A and B| / (|A| + |B|); 1 for equal roots."""
    a, b = F.array_distinct(_digests(left, 3, PIECE_DIGITS)), F.array_distinct(_digests(right, 3, PIECE_DIGITS))
    shared = 2.0 * F.size(F.array_intersect(a, b)) / F.greatest(F.size(a) + F.size(b), F.lit(1))
    return F.when(root(left) == root(right), F.lit(1.0)).when(F.col(left).isNull() | F.col(right).isNull(), F.lit(0.0)).otherwise(shared)


def edited_sections(left: str, right: str) -> Column:
    """Numbers (from 0) of the sections that differ; sections that one text lacks count as differing."""
    a, b = _digests(left, 2, SECTION_DIGITS), _digests(right, 2, SECTION_DIGITS)
    n = F.greatest(F.size(a), F.size(b))
    return F.filter(F.sequence(F.lit(0), n - 1), lambda i: ~F.try_element_at(a, i + 1).eqNullSafe(F.try_element_at(b, i + 1)))


def next_lower(keys: DataFrame) -> DataFrame:
    """For each distinct non-null ``k`` the largest one below it, as ``below`` (null for the smallest).

    Keys are grouped by their upper bits, level by level, so that no window holds more than 65,536 rows.
    """
    return _below(keys.select(F.col("k").cast("bigint").alias("k")).where("k IS NOT NULL").distinct(), 64 // ID_BITS_PER_LEVEL - 1)


def _below(keys: DataFrame, levels: int) -> DataFrame:
    if not levels:
        return keys.withColumn("below", F.lead("k").over(Window.orderBy(F.desc("k"))))
    up = keys.withColumn("up", F.shiftright("k", ID_BITS_PER_LEVEL))
    tops = up.groupBy("up").agg(F.max("k").alias("highest"))
    parents = _below(tops.select(F.col("up").alias("k")), levels - 1)
    reached = parents.join(tops.select(F.col("up").alias("below"), "highest"), "below").select(F.col("k").alias("up"), "highest")
    inside = up.withColumn("inside", F.lead("k").over(Window.partitionBy("up").orderBy(F.desc("k"))))
    last = inside.where("inside IS NULL").join(reached, "up", "left").select("k", F.col("highest").alias("below"))
    return inside.where("inside IS NOT NULL").select("k", F.col("inside").alias("below")).unionByName(last)


def with_next_text(docs: DataFrame) -> DataFrame:
    """Each row with ``next_text``: the text of the largest doc_id below its own, for the smallest that of the largest.

    Texts move into blocks of neighbouring ids, once for all rows and once to find the edges of
    blocks; only the edges are joined.
    """
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = own.where("doc_id IS NOT NULL").withColumn("block", F.shiftright("doc_id", BLOCK_BITS))
    down = Window.partitionBy("block").orderBy(F.desc("doc_id"), F.asc("text"))
    follower = F.lead(F.struct("doc_id", "text")).over(down)
    walked = blocks.withColumn("_follower", follower).withColumn("_place", F.row_number().over(down))
    # of rows that repeat a doc_id only the last one sees the next id
    other = F.when(F.col("_follower.doc_id") != F.col("doc_id"), F.col("_follower.text"))
    walked = walked.withColumn("next_text", F.max(other).over(Window.partitionBy("block", "doc_id")))
    # written, as the plans of its two uses would move all texts once each
    frontier = written_table(
        walked.where("_place = 1 OR next_text IS NULL").select(
            "block", "doc_id", "text", (F.col("_place") == 1).alias("is_head"), F.col("next_text").isNull().alias("is_edge")
        ),
        "block-edges",
    )
    heads = frontier.where("is_head").select(F.col("block").alias("next_block"), F.col("text").alias("head"))
    keys = own.select(F.shiftright("doc_id", BLOCK_BITS).alias("k"))
    highest = keys.agg(F.max("k")).first()[0]
    following = next_lower(keys).select(F.col("k").alias("block"), F.coalesce("below", F.lit(highest)).alias("next_block"))
    edges = frontier.where("is_edge").join(following, "block").join(heads, "next_block")
    return (
        walked.where("next_text IS NOT NULL").select("doc_id", "text", "next_text")
        .unionByName(edges.select("doc_id", "text", F.col("head").alias("next_text")))
        .unionByName(own.where("doc_id IS NULL").select("doc_id", "text", F.lit("").alias("next_text")))
    )


def with_neighbour_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next text, by descending doc_id.

    The edited text has its last floor(n/2) code points replaced by the first as many of the next text.
    Rows with a null doc_id come out with an empty next text; of rows that repeat a doc_id the
    smallest text serves as the next one.
    """
    paired = with_next_text(docs).withColumn("n_chars", F.length("text").cast("bigint"))
    edited = paired.withColumn(
        "edited", F.expr("concat(left(text, cast(n_chars - n_chars div 2 as int)), left(next_text, cast(n_chars div 2 as int)))")
    )
    for text, out in (("text", "fingerprint"), ("edited", "edited_fingerprint"), ("next_text", "next_fingerprint")):
        edited = fingerprints(edited, text, out)
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
