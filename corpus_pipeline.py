"""Corpus preparation: quality rules, near duplicates, repeated passages, mixing of sources, packing.

Every stage takes what its predecessor kept and is written before the next one reads it, so a stage drops the intermediate
tables of its predecessor.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replaykit.llm import divergence, packing, parity_join, poisson_mix, suffix_dedup
from replaykit.llm.catalog import prepare, query, table
from replaykit.session import drop_tables, shared_dir, written_so_far

# No stage after the first can be told in SQL (sketch joins, byte runs, hash-seeded copies, packing).
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie far from every language reference go."""
    return divergence.judged(docs).where("kept").select("row.*")


def _held(docs: DataFrame) -> DataFrame:
    """Each row as ``row``, so that no column of it clashes with another name, with its id and the digest of its text."""
    row = F.struct(*[docs[c] for c in docs.columns])
    return docs.select(row.alias("row"), docs["doc_id"].cast("bigint").alias("own_id"), parity_join.text_digest(docs["text"].cast("string")).alias("own_digest"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays.

    Of rows that repeat both doc_id and text one stays; different texts of one doc_id are judged each by its own links, and so are
    rows without doc_id, which stay.
    """
    placed = parity_join.near_duplicates(docs)
    staying = placed.where("doc_id = component_id").select(F.col("doc_id").alias("own_id"), F.col("text_digest").alias("own_digest")).distinct()
    held = _held(docs)
    named = held.join(staying, ["own_id", "own_digest"], "left_semi").dropDuplicates(["own_id", "own_digest"])
    return named.select("row").unionByName(held.where("own_id IS NULL").select("row")).select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in strings that occur elsewhere too are cut from the texts; no document goes."""
    cut = suffix_dedup.cuts(docs, want_text=True).where("n_removed > 0")
    cut = cut.select(F.col("doc_id").alias("cut_id"), F.col("digest").alias("cut_digest"), "kept")
    same = F.col("own_id").eqNullSafe(F.col("cut_id")) & (F.col("own_digest") == F.col("cut_digest"))
    joined = _held(docs).join(cut, same, "left")
    was_cut, row = F.col("cut_digest").isNotNull(), F.col("row")
    changed = {"text": F.when(was_cut, F.col("kept")).otherwise(row["text"])}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(was_cut, F.length("kept").cast("bigint")).otherwise(row["n_chars"])
    return joined.select(*[changed.get(c, row[c]).alias(c) for c in docs.columns])


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are replicated to their target weights and shuffled."""
    row = F.struct(*[docs[c] for c in docs.columns])
    return poisson_mix.replicated(docs.select(row.alias("row"), "doc_id", "source")).select("row.*")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences."""
    return packing.packed(docs)


_earlier: list[str] = []


def _with_scratch(stage):
    """A stage that first drops the intermediate tables of the stage before, whose result is written by then."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        drop_tables(spark, _earlier)
        before = set(written_so_far())
        out = stage(spark, docs, sf_dir)
        _earlier[:] = [p for p in written_so_far() if p not in before]
        return out

    return run


STAGES = [
    (f.__name__, _with_scratch(f)) for f in (quality_rules, near_duplicates, repeated_passages, mixed_sources, packed_sequences)
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


query("pipeline", ORACLE_SQL)(run)
