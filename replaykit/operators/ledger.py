"""Questions over the append-only replay-event ledger, for all dates and sources at once.

Two notions never mix: the *latest attempt* may regress, *logical completion*
never does.  Ties on ``recorded_at`` go to the greater ``event_id``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.registry import DAILY_SOURCES
from .slicing import expected_grid

PAIR = ("delivery_date", "source_object")


def newest_per(df: DataFrame, keys: Sequence[str], tie_break: str) -> DataFrame:
    """Newest row per key.

    Spark keeps one row per key inside every input partition before the
    shuffle (window group limit), so a key holding most rows costs no more
    than any other.
    """
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("recorded_at"), F.desc(tie_break))
    ranked = df.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def history(events: DataFrame, pairs: DataFrame, tie_break: str = "event_id") -> DataFrame:
    """All events of the requested pairs, oldest first within a pair.

    The order is a distributed range sort over date, source, time and id, so no
    pair is gathered in one task.
    """
    wanted = events.join(pairs.select(*PAIR).distinct(), list(PAIR), "left_semi")
    return wanted.orderBy(*PAIR, "recorded_at", tie_break)


def latest_attempt_per_source(events: DataFrame) -> DataFrame:
    return newest_per(events, PAIR, "event_id")


def latest_attempt(events: DataFrame, pairs: DataFrame) -> DataFrame:
    """Newest event of each requested pair; null event columns when never attempted."""
    wanted = pairs.select(*PAIR).distinct()
    theirs = events.join(wanted, list(PAIR), "left_semi")
    return wanted.join(latest_attempt_per_source(theirs), list(PAIR), "left")


def logical_completion(events: DataFrame) -> DataFrame:
    """Newest success per pair.  Filtering first is what makes completion permanent."""
    return newest_per(events.filter(F.col("status") == "success"), PAIR, "event_id")


def pair_state(events: DataFrame) -> DataFrame:
    """Latest attempt and completion of every pair from a single pass over the ledger."""
    newest = F.struct("recorded_at", "event_id")
    return (
        events.groupBy(*PAIR)
        .agg(
            F.max_by(F.struct("status", "stage", "recorded_at", "event_id"), newest).alias("latest"),
            F.max(F.col("status") == "success").alias("completed"),
        )
        .select(
            *PAIR,
            F.col("latest.status").alias("latest_status"),
            F.col("latest.stage").alias("latest_stage"),
            F.col("latest.recorded_at").alias("latest_recorded_at"),
            F.col("latest.event_id").alias("latest_event_id"),
            "completed",
        )
    )


def regressed_sources(events: DataFrame) -> DataFrame:
    """Completed pairs whose latest attempt is not a success."""
    return pair_state(events).filter(F.col("completed") & (F.col("latest_status") != "success"))


def completeness(completed: DataFrame, days: DataFrame, expected: Sequence[str] = DAILY_SOURCES) -> DataFrame:
    """Whether each day's completed set equals the expected set exactly.

    ``completed`` holds one success per pair.  Duplicate pairs or an empty
    expected set are malformed input and fail, rather than reading as
    incomplete.  Counting known and unknown names needs no name lists.
    """
    if not expected:
        raise ValueError("expected sources cannot be empty")
    known = F.col("source_object").isin(*expected)
    per_pair = completed.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col("status") == "success").alias("all_success")
    )
    message = F.concat(F.lit("duplicate completion rows: "), F.col("source_object"))
    unique = per_pair.filter(
        F.when(F.col("n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    )
    per_day = unique.groupBy("delivery_date").agg(
        F.count_if(known & F.col("all_success")).alias("n_completed"),
        F.count_if(~known).alias("n_unexpected"),
    )
    zero = F.lit(0).cast("bigint")
    return (
        days.join(per_day, "delivery_date", "left")
        .select(
            "delivery_date",
            F.coalesce("n_completed", zero).alias("n_completed"),
            F.coalesce("n_unexpected", zero).alias("n_unexpected"),
        )
        .withColumn("complete", (F.col("n_completed") == len(set(expected))) & (F.col("n_unexpected") == 0))
    )


def of_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of the requested days, before any ranking or counting."""
    return rows.join(days.select("delivery_date").distinct(), "delivery_date", "left_semi")


def date_completeness(events: DataFrame, days: DataFrame, expected: Sequence[str] = DAILY_SOURCES) -> DataFrame:
    return completeness(logical_completion(of_days(events, days)), days, expected)


def incomplete_summary(events: DataFrame, days: DataFrame, expected: Sequence[str] = DAILY_SOURCES) -> DataFrame:
    """Per day, every expected source that never completed and where its last attempt stopped."""
    grid = expected_grid(days, tuple(expected))
    state = pair_state(of_days(events, days)).select(*PAIR, "latest_status", "latest_stage", "completed")
    open_pairs = grid.join(state, list(PAIR), "left").filter(
        ~F.coalesce("completed", F.lit(False))
    )
    attempt = F.coalesce(
        F.concat_ws("|", F.when(F.col("latest_status").isNotNull(), F.col("latest_status")), "latest_stage"),
        F.lit(""),
    )
    text = F.concat(
        F.col("source_object"),
        F.lit("="),
        F.when(F.col("latest_status").isNull(), "not attempted").otherwise(attempt),
    )
    return open_pairs.groupBy("delivery_date").agg(
        F.array_join(F.array_sort(F.collect_list(text)), ", ").alias("summary")
    )


def range_progress(daily: DataFrame, range_id: str = "range_id") -> DataFrame:
    """Where each requested range stopped: days after its first incomplete one were not attempted.

    Input is one row per range and day, so a window partition is as long as
    the range has days.
    """
    before = (
        Window.partitionBy(range_id)
        .orderBy("delivery_date")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    failed_before = F.coalesce(F.max(~F.col("complete")).over(before), F.lit(False))
    progress = (
        F.when(failed_before, "not_attempted").when(F.col("complete"), "complete").otherwise("incomplete")
    )
    return daily.withColumn("progress", progress)


def run_event_counts(events: DataFrame) -> DataFrame:
    """Events, distinct event ids and date span of each run."""
    per_id = events.groupBy("run_id", "event_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("delivery_date").alias("first_date"),
        F.max("delivery_date").alias("last_date"),
    )
    return per_id.groupBy("run_id").agg(
        F.sum("n").alias("n_events"),
        F.count(F.lit(1)).alias("n_event_ids"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )


def warehouse_eligible(outcomes: DataFrame) -> DataFrame:
    """Only sources that were ingested may be loaded."""
    return outcomes.filter(F.col("ingest_ok"))


def _steps(*steps: tuple[str, str]) -> Column:
    return F.array(*[F.struct(F.lit(s).alias("status"), F.lit(g).alias("stage")) for s, g in steps])


RUN_INGEST, RUN_LOAD = ("running", "ingestion"), ("running", "warehouse")


def replay_steps(ingest_ok: Column, load_ok: Column) -> Column:
    """State transitions of a replayed source, in order."""
    return (
        F.when(~ingest_ok, _steps(RUN_INGEST, ("failed", "ingestion")))
        .when(~load_ok, _steps(RUN_INGEST, RUN_LOAD, ("failed", "warehouse")))
        .otherwise(_steps(RUN_INGEST, RUN_LOAD, ("success", "warehouse")))
    )


def load_steps(load_ok: Column) -> Column:
    """State transitions of a source whose landed artifact is reused."""
    return F.when(load_ok, _steps(RUN_LOAD, ("success", "warehouse"))).otherwise(
        _steps(RUN_LOAD, ("failed", "warehouse"))
    )


def confirm_steps(confirmed: Column) -> Column:
    """Proven completion adds one success and no running event; anything else adds nothing."""
    return F.when(confirmed, _steps(("success", "warehouse")))


def explode_steps(outcomes: DataFrame, steps: Column, run_id: str, attempt: Column | None = None) -> DataFrame:
    """One row per transition with an id derived from its identity.

    A derived id makes a retried task, or a repeated append of the same rows,
    produce the same events again, which the append then drops.  State and
    ``attempt`` (a text, such as the time an attempt began) belong to the
    identity, so a run that is retried under its own id adds new events.
    """
    exploded = outcomes.select("*", F.posexplode(steps).alias("step", "event"))
    parts = [
        F.lit(run_id), F.col("delivery_date").cast("string"), F.col("source_object"), F.col("step").cast("string"),
        F.col("event.status"), F.col("event.stage"),
    ]
    identity = F.concat_ws("|", *parts, *([] if attempt is None else [attempt]))
    return exploded.select(
        *[c for c in outcomes.columns],
        "step",
        F.lit(run_id).alias("run_id"),
        F.sha2(identity, 256).alias("event_id"),
        F.col("event.status").alias("status"),
        F.col("event.stage").alias("stage"),
    )


def events_from_outcomes(outcomes: DataFrame, run_id: str) -> DataFrame:
    return explode_steps(outcomes, replay_steps(F.col("ingest_ok"), F.col("load_ok")), run_id)
