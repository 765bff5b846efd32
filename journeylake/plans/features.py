"""Per-prospect features and scores. The specification names these tables and their
grain only; the columns are ours."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import contains_folded, count_when, event_counts, ratio
from ..functions.labels import census_region, channel_category
from ..operators.quality import parsed_rejects
from ..operators.star import map_email_to_stage
from .common import is_suppression


def prospect_360_features(dim_prospect: DataFrame, fact: DataFrame, as_of: str) -> DataFrame:
    """Recency, volume and intensity per prospect; prospects without events have zeros."""
    day = F.lit(as_of).cast("date")
    counts = fact.groupBy(F.col("subscriber_key").alias("master_patient_id")).agg(
        *event_counts(sends="SENT", opens="OPEN", clicks="CLICK", bounces="BOUNCE", unsubscribes="UNSUBSCRIBE"),
        F.max("event_timestamp").alias("last_event"),
    )
    numbers = ["sends", "opens", "clicks", "bounces", "unsubscribes"]
    return (
        dim_prospect.join(counts, "master_patient_id", "left").na.fill(0, numbers)
        .select(
            "master_patient_id", "age", "age_group", "state", census_region("state").alias("region"),
            "primary_channel", "patient_consent", "intake_count",
            F.datediff(day, "last_intake_date").alias("days_since_intake"),
            F.datediff("last_intake_date", "first_intake_date").alias("intake_span_days"),
            *numbers,
            ratio("opens", "sends", 1.0).alias("open_rate"),
            ratio("clicks", "sends", 1.0).alias("click_rate"),
            ratio(F.col("opens") + F.col("clicks") * 2, "sends", 1.0).alias("engagement_intensity"),
            F.datediff(day, F.to_date("last_event")).alias("days_since_event"),
        )
    )


def send_time_features(fact: DataFrame) -> DataFrame:
    """Best hour and weekday of opens and clicks per subscriber. Ties go to the earlier
    one. Events shrink to (subscriber, hour, weekday) counts before they meet per key."""
    cells = (
        fact.filter(F.col("event_type").isin("OPEN", "CLICK"))
        .groupBy(
            "subscriber_key", F.hour("event_timestamp").alias("h"),
            (F.dayofweek("event_timestamp") - 1).alias("d"),
        ).agg(F.count(F.lit(1)).alias("n"))
    )
    by_hour = cells.groupBy("subscriber_key", "h").agg(F.sum("n").alias("n")).groupBy("subscriber_key").agg(
        F.max_by("h", F.struct(F.col("n"), -F.col("h"))).alias("best_hour"),
        F.max("n").alias("best_hour_events"),
        F.sum("n").alias("engagement_events"),
    )
    by_day = cells.groupBy("subscriber_key", "d").agg(F.sum("n").alias("n")).groupBy("subscriber_key").agg(
        F.max_by("d", F.struct(F.col("n"), -F.col("d"))).alias("best_weekday"),
    )
    return by_hour.join(by_day, "subscriber_key").withColumn(
        "confidence", ratio("best_hour_events", "engagement_events", 1.0)
    )


def send_time_profile(fact: DataFrame) -> DataFrame:
    """Events by weekday and hour over all subscribers."""
    return fact.groupBy(
        (F.dayofweek("event_timestamp") - 1).alias("weekday"), F.hour("event_timestamp").alias("hour")
    ).agg(*event_counts(sends="SENT", opens="OPEN", clicks="CLICK"))


def signal_trust(dim_prospect: DataFrame, fact: DataFrame, rejects: DataFrame) -> DataFrame:
    """Trust in a prospect's signals, 1 minus penalties: 0.1 per refused lead of the same
    e-mail (at most 0.3), 0.4 if suppressed, 0.2 if a send failed fatally, 0.05 per bounce
    (at most 0.1)."""
    parsed = parsed_rejects(rejects)
    refused = parsed.filter(~is_suppression() & F.col("rec.EMAIL").isNotNull()).groupBy(
        F.lower(F.trim("rec.EMAIL")).alias("email")
    ).agg(F.count(F.lit(1)).alias("dq_issues"))
    fatal = parsed.filter(F.upper("rejection_reason") == "FATAL_ERROR").groupBy(
        F.col("rec.PROSPECT_ID").alias("master_patient_id")
    ).agg(F.count(F.lit(1)).alias("fatal_errors"))
    seen = fact.groupBy(F.col("subscriber_key").alias("master_patient_id")).agg(
        count_when(F.coalesce("is_suppressed", F.lit(False))).alias("suppressed_events"),
        *event_counts(bounces="BOUNCE"),
    )
    numbers = ["dq_issues", "fatal_errors", "suppressed_events", "bounces"]
    rows = (
        dim_prospect.select("master_patient_id", "email")
        .join(refused, "email", "left")
        .join(seen, "master_patient_id", "left")
        .join(fatal, "master_patient_id", "left")
        .na.fill(0, numbers)
    )
    penalty = (
        F.least(F.col("dq_issues") * 10, F.lit(30))
        + F.when(F.col("suppressed_events") > 0, 40).otherwise(0)
        + F.when(F.col("fatal_errors") > 0, 20).otherwise(0)
        + F.least(F.col("bounces") * 5, F.lit(10))
    )
    return rows.select("master_patient_id", *numbers, ((F.lit(100) - penalty) / 100.0).cast("double").alias("trust"))


def _flag(c: Column) -> Column:
    return F.when(c, 1.0).otherwise(0.0)


def prospect_vectors(features: DataFrame) -> DataFrame:
    """Prospect profile space: region, channel kind, consent, age, recency, intensity."""
    parts = [
        *[_flag(F.col("region") == r) for r in ("Northeast", "Midwest", "South", "West")],
        _flag(channel_category("primary_channel") == "Digital"),
        _flag(F.col("patient_consent")),
        F.coalesce(F.col("age") / 100.0, F.lit(0.0)),
        F.coalesce(1.0 / (1.0 + F.greatest(F.col("days_since_intake"), F.lit(0)) / 365.0), F.lit(0.0)),
        F.coalesce(F.least(F.col("engagement_intensity"), F.lit(5.0)) / 5.0, F.lit(0.0)),
    ]
    text = F.concat_ws(" ", "primary_channel", "age_group", "region")
    return features.select(
        F.col("master_patient_id").alias("id"), F.array(*[p.cast("double") for p in parts]).alias("vector"),
        text.alias("text"),
    )


def journey_vectors(jobs: DataFrame) -> DataFrame:
    """Journey stage space: journey, stage position, path and resend."""
    mapped = jobs if "stage_number" in jobs.columns else map_email_to_stage(jobs)
    parts = [
        *[_flag(F.col("journey_code").startswith(j)) for j in ("J01", "J02", "J03", "J04")],
        F.coalesce(F.col("stage_number") / 9.0, F.lit(0.0)),
        _flag(F.col("stage_number") <= 7),
        _flag(F.col("is_resend")),
    ]
    return mapped.select(
        F.col("email_name").alias("id"), F.array(*[p.cast("double") for p in parts]).alias("vector"),
        F.concat_ws(" ", "journey_name", "stage_name").alias("text"),
    )


def journey_stage_vectors(mart: DataFrame) -> DataFrame:
    """Observed stage space, one entity per (journey, stage) of the mart: journey, event mix,
    shares of unique and suppressed events, volume and days in the stage.

    Events are counted per prospect first, which also gives each prospect's days.
    """
    kinds = dict(n_sent="SENT", n_open="OPEN", n_click="CLICK", n_bounce="BOUNCE", n_unsub="UNSUBSCRIBE", n_spam="SPAM")
    per = mart.filter("journey_type is not null and mapped_stage is not null").groupBy(
        "journey_type", "mapped_stage", "prospect_id"
    ).agg(
        F.count(F.lit(1)).alias("n"), *event_counts(**kinds),
        F.sum("is_unique_event").alias("n_unique"), F.sum("is_suppressed_event").alias("n_suppressed"),
        F.datediff(F.max("event_timestamp"), F.min("event_timestamp")).alias("days"),
    )
    sums = ["n", *kinds, "n_unique", "n_suppressed", "days"]
    stages = per.groupBy("journey_type", "mapped_stage").agg(
        *[F.sum(c).alias(c) for c in sums], F.count(F.lit(1)).alias("prospects"))
    parts = [
        *[_flag(F.col("journey_type").startswith(j)) for j in ("J01", "J02", "J03", "J04")],
        *[F.col(c) / F.col("n") for c in (*kinds, "n_unique", "n_suppressed")],
        F.log1p("n") / 20.0,
        F.col("days") / F.col("prospects") / 30.0,
    ]
    return stages.select(
        F.concat_ws("|", "journey_type", "mapped_stage").alias("id"),
        F.array(*[p.cast("double") for p in parts]).alias("vector"),
        F.concat_ws(" ", "journey_type", "mapped_stage").alias("text"),
    )


def document_vectors(docs: DataFrame, keywords: Sequence[str] = (), buckets: int = 128) -> DataFrame:
    """Term space of documents (id, text): counts of hashed words of the whole text. ``text``
    of the result holds those of ``keywords`` the document contains, so that no whole text is
    shuffled. A document without a word has no direction and no row."""
    # Held keywords are bits of numbers: with strings in its rows Spark would sort all words to count them.
    held = [[(w, F.when(contains_folded("text", w), 1 << j).otherwise(0).cast("long")) for j, w in enumerate(keywords[i : i + 62])]
            for i in range(0, len(keywords), 62)]
    marks = [reduce(add, [bit for _, bit in some]).alias(f"_held{i}") for i, some in enumerate(held)]
    names = [f"_held{i}" for i in range(len(held))]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # Both before the explode, which would evaluate them once a word.
    split = docs.select("id", *marks, F.split(lowered, "[^a-z0-9]+").alias("words"))
    words = split.select("id", *names, F.explode("words").alias("word")).filter("word != ''")
    number = F.conv(F.substring(F.md5(F.col("word").cast("binary")), 1, 4), 16, 10).cast("int")
    counts = words.groupBy("id", (number % buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in names])
    by_bucket = F.map_from_entries(F.collect_list(F.struct("bucket", "n")))
    bags = counts.groupBy("id").agg(by_bucket.alias("bag"), *[F.first(c).alias(c) for c in names])
    found = F.concat_ws(" ", *[F.when(F.col(c).bitwiseAND(F.lit(1 << j)) != 0, F.lit(w))
                               for c, some in zip(names, held) for j, (w, _) in enumerate(some)], F.lit(""))
    dense = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda i: F.coalesce(F.try_element_at("bag", i), F.lit(0)).cast("double"))
    return bags.select("id", dense.alias("vector"), found.alias("text"))


def rejection_vectors(rejects: DataFrame) -> DataFrame:
    """Rejection space: one entity per (table, reason, channel) with its volume."""
    from .. import fixed_values as fv

    reasons = (*fv.LEAD_REJECT_REASONS, fv.NO_CONSENT, *fv.SUPPRESSION_REASONS)
    grouped = parsed_rejects(rejects).groupBy(
        "table_name", "rejection_reason", F.coalesce("rec.CHANNEL", F.lit("none")).alias("channel")
    ).agg(F.count(F.lit(1)).alias("n"))
    parts = [
        *[_flag(F.upper("rejection_reason") == r) for r in reasons],
        _flag(is_suppression()),
        _flag(F.col("channel") == "none"),
        F.log1p("n") / 10.0,
    ]
    name = F.concat_ws("|", "table_name", "rejection_reason", "channel")
    return grouped.select(
        name.alias("id"), F.array(*[p.cast("double") for p in parts]).alias("vector"), name.alias("text")
    )


def engagement_vectors(fact: DataFrame) -> DataFrame:
    """Engagement space: event mix, click-to-open and bounce share, share by part of day."""
    kinds = dict(sends="SENT", opens="OPEN", clicks="CLICK", bounces="BOUNCE", unsubscribes="UNSUBSCRIBE", spam="SPAM")
    hour = F.hour("event_timestamp")
    per = fact.groupBy("subscriber_key").agg(
        *event_counts(**kinds),
        F.count(F.lit(1)).alias("n"),
        *[count_when((hour >= lo) & (hour < lo + 6)).alias(f"p{lo}") for lo in (0, 6, 12, 18)],
    )
    parts = [
        *[ratio(k, "n", 1.0) for k in kinds],
        F.coalesce(F.least(ratio("clicks", "opens", 1.0), F.lit(1.0)), F.lit(0.0)),
        *[ratio(f"p{lo}", "n", 1.0) for lo in (0, 6, 12, 18)],
    ]
    return per.select(F.col("subscriber_key").alias("id"), F.array(*parts).alias("vector"),
                      F.col("subscriber_key").alias("text"))
