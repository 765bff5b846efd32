"""Journey-stage questions over the wide journey table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.columns import count_when, is_true_text, lead_date, ratio, truthy
from ..operators.star import map_email_to_stage, stage_waits

WIDE_COLUMNS = ("prospect_id", "welcome_journey_complete", "nurture_journey_complete", "suppression_flag") + tuple(
    c for s in fv.STAGES for c in (f"{s[4]}_sent", f"{s[4]}_sent_date")
)


def stage_rows(details: DataFrame, *keep: str) -> DataFrame:
    """The nine (flag, date) column pairs as nine rows per prospect, in one pass."""
    pairs = F.array(*[
        F.struct(
            F.lit(s[0]).alias("stage_number"),
            F.lit(s[1]).alias("journey_code"),
            F.lit(s[5]).alias("stage"),
            F.col(f"{s[4]}_sent").alias("flag"),
            F.col(f"{s[4]}_sent_date").cast("string").alias("day"),
        )
        for s in fv.STAGES
    ])
    # Texts are read after the explode, so that the plan holds one date parser, not nine.
    return details.select(
        "prospect_id", truthy("suppression_flag").alias("suppressed"), *keep, F.explode(pairs).alias("s")
    ).select(
        "prospect_id", "suppressed", *keep, "s.stage_number", "s.journey_code", "s.stage",
        is_true_text("s.flag").alias("sent"), lead_date("s.day").alias("sent_date"),
    )


def _scoped(details: DataFrame, prospect_id: str | None) -> DataFrame:
    return details if prospect_id is None else details.filter(F.col("prospect_id") == prospect_id)


def stage_send_summary(
    details: DataFrame, prospect_id: str | None = None, day: str | None = None
) -> DataFrame:
    """Per stage: prospects, sent, not sent, suppressed. A null flag counts as neither
    sent nor not sent. ``day`` keeps stage rows with that send date."""
    rows = stage_rows(_scoped(details, prospect_id))
    if day is not None:
        rows = rows.filter(F.col("sent_date") == F.lit(day).cast("date"))
    return (
        rows.groupBy("stage_number", "stage")
        .agg(
            F.count(F.lit(1)).alias("total_prospects"),
            count_when(F.col("sent")).alias("sent"),
            count_when(~F.col("sent")).alias("not_sent"),
            count_when(F.col("suppressed")).alias("suppressed"),
        )
        .orderBy("stage_number").drop("stage_number")
    )


def last_stage_label() -> Column:
    ladder = None
    for s in reversed(fv.STAGES):
        hit = is_true_text(f"{s[4]}_sent")
        ladder = F.when(hit, s[6]) if ladder is None else ladder.when(hit, s[6])
    return ladder.otherwise(fv.NO_STAGE)


def last_stage_number() -> Column:
    ladder = None
    for s in reversed(fv.STAGES):
        hit = is_true_text(f"{s[4]}_sent")
        ladder = F.when(hit, s[0]) if ladder is None else ladder.when(hit, s[0])
    return ladder.otherwise(0)


def last_email_date() -> Column:
    """Latest send date over the nine stages; 1900-01-01 when there is none."""
    nothing = F.lit(fv.NULL_DATE).cast("date")
    return F.greatest(*[F.coalesce(lead_date(f"{s[4]}_sent_date"), nothing) for s in fv.STAGES])


def suppressed_last_stage(
    details: DataFrame, unsubscribes: DataFrame, prospect_id: str | None = None, limit: int | None = None
) -> DataFrame:
    """Flagged prospects with the last stage they got and their unsubscribe rows.

    ``last_email`` is the same date with the 1900 stand-in turned back to null.
    """
    flagged = _scoped(details, prospect_id).filter(truthy("suppression_flag")).select(
        "prospect_id", last_stage_label().alias("last_stage_reached"), last_email_date().alias("last_email_date")
    )
    unsub = unsubscribes.select(
        F.col("subscriber_key").alias("u_key"), F.col("event_date").alias("unsubscribe_date"),
        F.col("reason").alias("unsubscribe_reason"), F.col("job_id").alias("unsubscribe_job_id"),
    )
    rows = flagged.join(unsub, F.col("prospect_id") == F.col("u_key"), "left").select(
        "prospect_id", "last_stage_reached", "last_email_date",
        F.nullif("last_email_date", F.lit(fv.NULL_DATE).cast("date")).alias("last_email"),
        "unsubscribe_date", "unsubscribe_reason", "unsubscribe_job_id",
        F.when(F.col("u_key").isNotNull(), "Unsubscribed")
        .otherwise("Suppressed (non-unsubscribe reason)").alias("suppression_type"),
    )
    if limit is None:
        return rows
    return rows.orderBy(
        F.col("last_email_date").desc_nulls_last(), "prospect_id", "unsubscribe_date", "unsubscribe_job_id"
    ).limit(limit)


def unsubscribe_reasons(unsubscribes: DataFrame) -> DataFrame:
    return unsubscribes.groupBy(
        F.coalesce("reason", F.lit("(no reason provided)")).alias("unsubscribe_reason")
    ).agg(
        F.countDistinct("subscriber_key").alias("prospect_count"),
        F.min("event_date").alias("first_unsubscribe_date"),
        F.max("event_date").alias("last_unsubscribe_date"),
    )


def expected_next_stage(details: DataFrame) -> DataFrame:
    """Next stage and its due date for every stage sent, from the fixed waits."""
    waits = F.broadcast(stage_waits(details.sparkSession))
    sent = stage_rows(details).filter(F.coalesce("sent", F.lit(False)) & F.col("sent_date").isNotNull())
    return sent.join(waits, F.col("stage_number") == F.col("from_stage")).select(
        "prospect_id", "suppressed", "from_stage", "to_stage",
        F.col("sent_date").alias("stage_date"),
        F.expr("date_add(sent_date, wait_days)").alias("expected_date"),
    )


def missed_sends(
    details: DataFrame, fact: DataFrame, rejects: DataFrame, jobs: DataFrame, day: str | None = None
) -> DataFrame:
    """Expected against actual sends per stage and date, with missed sends by reason.

    A send is actual when a SENT event of that stage's job exists for the prospect on the
    due date. Reasons of a missed send, first match: suppressed, fatal error, bounced,
    unsubscribed, else unknown. ``jobs`` (job_id, email_name) tells the stage of a job: job ids
    are numbers of the mailing platform.
    """
    due = expected_next_stage(details)
    if day is not None:
        due = due.filter(F.col("expected_date") == F.lit(day).cast("date"))
    stage_of = map_email_to_stage(jobs).select("job_id", "stage_number").filter("stage_number is not null").distinct()
    sent = fact.filter((F.col("event_type") == "SENT") & F.col("job_id").isNotNull()).groupBy(
        F.col("subscriber_key").alias("s_key"), "job_id", F.to_date("event_timestamp").alias("s_day")
    ).agg(F.lit(True).alias("was_sent")).join(stage_of, "job_id").select(
        "s_key", F.col("stage_number").alias("s_stage"), "s_day", "was_sent").distinct()
    negatives = fact.filter(F.col("event_type").isin("BOUNCE", "UNSUBSCRIBE")).groupBy(
        F.col("subscriber_key").alias("n_key")
    ).agg(
        F.min(F.when(F.col("event_type") == "BOUNCE", F.to_date("event_timestamp"))).alias("bounce_day"),
        F.min(F.when(F.col("event_type") == "UNSUBSCRIBE", F.to_date("event_timestamp"))).alias("unsub_day"),
    )
    fatal = rejects.filter(F.upper("rejection_reason") == "FATAL_ERROR").select(
        F.get_json_object("rejected_record", "$.PROSPECT_ID").alias("f_key"), F.lit(True).alias("is_fatal")
    ).filter("f_key is not null").distinct()
    rows = (
        due.join(sent, (F.col("prospect_id") == F.col("s_key")) & (F.col("to_stage") == F.col("s_stage"))
                 & (F.col("expected_date") == F.col("s_day")), "left")
        .join(negatives, F.col("prospect_id") == F.col("n_key"), "left")
        .join(fatal, F.col("prospect_id") == F.col("f_key"), "left")
    )
    missed = F.col("was_sent").isNull()
    reason = (
        F.when(~missed, "SENT")
        .when(F.col("suppressed"), "SUPPRESSED_PROSPECT")
        .when(F.col("is_fatal"), "FATAL_ERROR")
        .when(F.col("bounce_day") <= F.col("expected_date"), "BOUNCE")
        .when(F.col("unsub_day") <= F.col("expected_date"), "UNSUBSCRIBED")
        .otherwise("UNKNOWN")
    )
    return rows.groupBy(F.col("to_stage").alias("stage_number"), "expected_date").agg(
        F.count(F.lit(1)).alias("expected_count"),
        count_when(~missed).alias("actual_count"),
        count_when(missed).alias("missed_count"),
        count_when(reason == "SUPPRESSED_PROSPECT").alias("missed_suppressed"),
        count_when(reason == "FATAL_ERROR").alias("missed_fatal"),
        count_when(reason == "BOUNCE").alias("missed_bounce"),
        count_when(reason == "UNSUBSCRIBED").alias("missed_unsubscribed"),
        count_when(reason == "UNKNOWN").alias("missed_unknown"),
    )


def suppressed_between_stages(details: DataFrame, unsubscribes: DataFrame) -> DataFrame:
    """Flagged prospects whose first unsubscribe came before the next stage was due."""
    waits = F.broadcast(stage_waits(details.sparkSession))
    first = unsubscribes.groupBy(F.col("subscriber_key").alias("u_key")).agg(
        F.min(F.to_date(F.col("event_date").try_cast("timestamp_ntz"))).alias("unsubscribe_day")
    )
    return (
        details.filter(truthy("suppression_flag"))
        .select("prospect_id", last_stage_number().alias("last_stage"), last_email_date().alias("last_email_date"))
        .join(waits, F.col("last_stage") == F.col("from_stage"))
        .join(first, F.col("prospect_id") == F.col("u_key"))
        .withColumn("next_due", F.expr("date_add(last_email_date, wait_days)"))
        .filter(F.col("unsubscribe_day") <= F.col("next_due"))
        .select("prospect_id", "last_stage", F.col("to_stage").alias("suppressed_before_stage"),
                "last_email_date", "next_due", "unsubscribe_day")
    )


def path_membership(details: DataFrame) -> DataFrame:
    """Per path and stage: prospects that reached it and dropped after it, and per path:
    entered, completed and average days between first and last send."""
    parts = []
    for path, stages in fv.PATH_STAGES.items():
        flags = {s[0]: F.coalesce(is_true_text(f"{s[4]}_sent"), F.lit(False)) for s in fv.STAGES if s[0] in stages}
        dates = [F.when(flags[s[0]], lead_date(f"{s[4]}_sent_date")) for s in fv.STAGES if s[0] in stages]
        entered = reduce(Column.__or__, flags.values())
        complete = reduce(Column.__and__, flags.values())
        days = F.datediff(F.greatest(*dates), F.least(*dates))
        # Sums of whole days keep the average exact whatever the order of rows.
        row = details.agg(
            count_when(entered).alias("entered"),
            count_when(complete).alias("completed"),
            F.sum(F.when(entered, days)).alias("day_sum"),
            F.count(F.when(entered, days)).alias("day_n"),
            *[count_when(flags[n]).alias(f"r{n}") for n in stages],
            *[count_when(flags[n] & ~flags[n + 1]).alias(f"d{n}") for n in stages[:-1]],
        )
        steps = F.array(*[
            F.struct(
                F.lit(n).alias("stage_number"), F.col(f"r{n}").alias("reached"),
                (F.col(f"d{n}") if n != stages[-1] else F.lit(0).cast("bigint")).alias("dropped"),
            )
            for n in stages
        ])
        parts.append(row.select(
            F.lit(path).alias("path"), "entered", "completed",
            ratio("day_sum", "day_n", 1.0).alias("avg_days_in_journey"), F.explode(steps).alias("s"),
        ).select("path", "s.stage_number", "s.reached", "s.dropped", "entered", "completed", "avg_days_in_journey"))
    return reduce(DataFrame.unionByName, parts)
