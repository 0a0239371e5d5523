"""Mixing sources to target weights by Poisson replication.

Every document is repeated k times, where k comes from inverting a Poisson distribution at a uniform number made of
the document's id and a seed; its mean is the repetition rate of the source: target rows of the source over its rows.
The copies are then shuffled globally by a hash.  Rates above RATE_PER_DRAW are the sum of several draws, each with a
uniform number of its own, as the smallest probability would vanish otherwise.

A null source is a source of its own.  Rows that repeat a doc_id get the same number of copies.  Null texts are
documents like others.  The columns of the input stay; ``copy`` (from 0) and ``shuffle_key`` are added, in place of input
columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replaykit.session import written_table

TEMPERATURE = 0.7
SEED = 20240229
RATE_PER_DRAW = 256.0


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) with 52 random bits from MD5 of the parts."""
    return (F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def rates(docs: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """Per source the repetition rate that gives it a share in proportion to rows ** temperature; the total stays."""
    sizes = docs.groupBy(_source(docs).alias("_source")).agg(F.count("*").cast("double").alias("n"))
    whole, weight = sizes.agg(F.coalesce(F.sum("n"), F.lit(0.0)), F.coalesce(F.sum(F.pow("n", F.lit(temperature))), F.lit(1.0))).first()
    return sizes.select("_source", (F.pow("n", F.lit(temperature)) / weight * whole / F.col("n")).alias("rate"))


def _source(docs: DataFrame) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))


def distributions(rated: DataFrame) -> DataFrame:
    """Add the number of draws and the cumulative probabilities of one draw, as far as they stay below 1."""
    steps = F.sequence(F.lit(1), F.ceil(F.col("mean") + 12 * F.sqrt("mean") + 30).cast("int"))
    start = F.struct(F.exp(-F.col("mean")).alias("p"), F.array(F.exp(-F.col("mean"))).alias("cdf"))
    grown = F.aggregate(
        steps,
        start,
        lambda a, j: F.struct(
            (a["p"] * F.col("mean") / j).alias("p"), F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + a["p"] * F.col("mean") / j)).alias("cdf")
        ),
    )
    return (
        rated.withColumn("draws", F.greatest(F.ceil(F.col("rate") / RATE_PER_DRAW), F.lit(1)).cast("int"))
        .withColumn("mean", F.col("rate") / F.col("draws"))
        .withColumn("cdf", grown["cdf"])
        .select("_source", "draws", "cdf")
    )


def replicated(docs: DataFrame, rated: DataFrame | None = None, seed: int = SEED) -> DataFrame:
    """All copies of all documents, globally shuffled; ``rated`` holds (_source, rate), by default those of rates()."""
    keep = [c for c in docs.columns if c.lower() not in ("copy", "shuffle_key")]
    # written, so that Spark knows its size: a few sources are sent to all tasks, and texts move once only
    table = written_table(distributions(rated if rated is not None else rates(docs)), "source-rates")
    held = docs.select(F.struct(*[docs[c] for c in keep]).alias("_row"), F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("_id"), _source(docs).alias("_source"))
    drawn = held.join(table, "_source")
    copies = F.aggregate(
        F.sequence(F.lit(1), F.col("draws")),
        F.lit(0),
        lambda a, d: a + F.aggregate("cdf", F.lit(0), lambda k, c: k + (c <= uniform(F.lit(str(seed)), F.col("_id"), d.cast("string"))).cast("int")),
    )
    repeated = drawn.withColumn("_copies", copies).where("_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    keyed = repeated.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(str(seed + 1)), F.col("_id"), F.col("copy").cast("string"))))
    return keyed.select("_row.*", "copy", "shuffle_key").orderBy("shuffle_key")
