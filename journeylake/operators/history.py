"""Silver quality ladder and slowly changing history (type 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed_values as fv
from ..functions.columns import blank_to_null
from ..session import stored
from .keyed import previous_value, repeat_rows, total_and_next, with_slices

# The attributes whose change opens a new version, with the value that
# stands for null when two versions are compared.
TRACKED = (
    ("first_name", "~"), ("last_name", "~"), ("email", "~"), ("phone_number", "~"), ("age", -1),
    ("address", "~"), ("apartment_no", "~"), ("city", "~"), ("state", "~"), ("zip_code", "~"),
    ("patient_consent", False), ("channel", "~"), ("is_active", False),
)
ROW_COLUMNS = (
    "record_id", "master_patient_id", "first_name", "last_name", "email", "phone_number", "age",
    "address", "apartment_no", "city", "state", "zip_code", "patient_consent", "channel",
    "submission_timestamp", "file_date", "phi_loaded_at", "is_active",
)
VERSION_COLUMNS = ("eff_start_date", "eff_end_date", "is_current", "version_num", "dq_passed")


def silver_quality(bronze: DataFrame, silver_ids: DataFrame, loaded_at: str = "phi_loaded_at") -> DataFrame:
    """Bronze rows with ``rejection_reason`` (null for rows that may enter silver).

    Repeated record ids keep the earliest (load time, file date, row content) row. Which ids
    may repeat or be in silver is found on hashes of the ids alone, written once: they are few
    as a rule, so that rows of other ids are neither shuffled nor grouped. Ids of these hashes
    are then compared themselves. Among them equal copies are counted before rows meet, so an
    id repeated very often costs one row per map task, and rejected copies are written out
    again at the end.
    """
    columns = bronze.columns
    hashed = F.xxhash64("record_id")
    found = bronze.select(hashed.alias("_hash"), F.lit(1).alias("_new"), F.lit(0).alias("_old")).unionByName(
        silver_ids.select(hashed.alias("_hash"), F.lit(0).alias("_new"), F.lit(1).alias("_old")))
    suspects = stored(
        found.groupBy("_hash").agg(F.sum("_new").alias("_new"), F.max("_old").alias("_old"))
        .filter("_new > 1 or (_new = 1 and _old = 1)").select("_hash"), "suspect-ids")
    clear = {"_copies": F.lit(1).cast("bigint"), "_is_first": F.lit(True), "_sid": F.lit(None).cast("string")}
    if suspects.isEmpty():
        flagged = bronze.withColumns(clear)
    else:
        suspect = hashed == F.col("_hash")
        single = bronze.join(suspects, suspect, "left_anti").withColumns(clear)
        place = F.struct(F.col(loaded_at), F.col("file_date"), F.md5(F.to_json(F.struct(*columns)).cast("binary")))
        packed = (
            bronze.join(suspects, suspect, "left_semi").groupBy(*columns)
            .agg(F.count(F.lit(1)).alias("_copies")).withColumn("_place", place)
        )
        first_place = packed.groupBy("record_id").agg(F.min("_place").alias("_first")).withColumnRenamed("record_id", "_rid")
        known = silver_ids.join(suspects, suspect, "left_semi").select(F.col("record_id").alias("_sid")).distinct()
        multiple = (
            packed.join(first_place, F.col("record_id").eqNullSafe(F.col("_rid")))
            .withColumn("_is_first", F.col("_place") == F.col("_first"))
            .join(known, F.col("record_id") == F.col("_sid"), "left").select(*single.columns)
        )
        flagged = single.unionByName(multiple)
    ladder = (
        F.when(blank_to_null("master_patient_id").isNull(), "NULL_MASTER_PATIENT_ID")
        .when(blank_to_null("first_name").isNull(), "NULL_FIRST_NAME")
        .when(blank_to_null("last_name").isNull(), "NULL_LAST_NAME")
        .when(blank_to_null("email").isNull() | (F.upper(F.trim("email")) == "N/A"), "NULL_EMAIL")
        .when(F.col("_sid").isNotNull(), "DUPLICATE_RECORD_ID")
    )
    duplicate = F.lit("DUPLICATE_RECORD_ID_IN_BRONZE")
    once = flagged.withColumn("_own", ladder)
    first = once.withColumn("rejection_reason", F.when(F.col("_own").isNotNull(), F.col("_own"))
                            .when(~F.col("_is_first"), duplicate))
    extra = repeat_rows(once.filter("_copies > 1"), F.col("_copies") - 1).withColumn(
        "rejection_reason", F.coalesce(F.col("_own"), duplicate)
    )
    keep = [*columns, "rejection_reason"]
    return first.select(*keep).unionByName(extra.select(*keep))


def _tracked() -> Column:
    return F.struct(*[F.coalesce(F.col(c), F.lit(stand_in)).alias(c) for c, stand_in in TRACKED])


def empty_current(spark, like: DataFrame) -> DataFrame:
    """A current-version table with no rows, typed after the incoming rows."""
    return (
        like.select(*ROW_COLUMNS).limit(0)
        .withColumn("eff_start_date", F.lit(None).cast("date"))
        .withColumn("eff_end_date", F.lit(None).cast("date"))
        .withColumn("is_current", F.lit(True))
        .withColumn("version_num", F.lit(0))
        .withColumn("dq_passed", F.lit(True))
    )


#: Rows of one prospect and month that one window group takes.
SLICE_ROWS = 100_000


_ORDER = ("_turn", "file_date", "phi_loaded_at", "record_id")


def _weight() -> Column:
    """The stored row weighs its own version number, every change after it weighs 1."""
    return F.when(F.col("_turn") == 0, F.col("version_num")).otherwise(1)


def _changed(chained: DataFrame) -> DataFrame:
    return chained.filter(F.col("_before").isNull() | (F.col("_before.v") != _tracked())).drop("_before")


def _numbered_whole(rows: DataFrame) -> DataFrame:
    """Changes with ``_version`` and ``_next_start``, one window group per prospect."""
    chain = Window.partitionBy("master_patient_id").orderBy(*_ORDER)
    changes = _changed(rows.withColumn("_before", F.lag(F.struct(_tracked().alias("v"))).over(chain)))
    upto = chain.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return changes.withColumns({
        "_version": F.sum(_weight()).over(upto), "_next_start": F.lead("eff_start_date").over(chain)})


def _numbered_sliced(rows: DataFrame, slice_rows: int) -> DataFrame:
    """The same over months and slices of them, for prospects with more rows."""
    rows = rows.withColumn(
        "_month",
        F.when(F.col("_turn") == 0, F.lit("0001-01-01").cast("date"))
        .otherwise(F.coalesce(F.trunc("file_date", "month"), F.lit("0001-02-01").cast("date"))),
    )
    key = ["master_patient_id"]
    rows = with_slices(rows, key, "_month", _ORDER, slice_rows, "_bucket")
    changes = _changed(previous_value(rows, key, "_bucket", _ORDER, _tracked(), "_before"))
    return total_and_next(
        changes, key, "_bucket", _ORDER, _weight(), "eff_start_date", "_version", "_next_start"
    ).drop("_month", "_bucket")


def scd2_versions(current: DataFrame, incoming: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Current rows and incoming valid rows chained into versions.

    Per key the stored current row comes first, then the batch by (file date, load time,
    record id). A row opens a version when a tracked attribute differs from the row
    before it; unchanged rows vanish. Returns every surviving version with ``is_current``
    and ``is_new``: closed rows belong into the history, current ones replace the current
    table. Rows without a prospect have no versions.

    Prospects of at most ``slice_rows`` rows, each with a start date, are one window group each
    and are shuffled once. Of the others, found on ids and dates alone, windows cover one
    prospect's rows of one month, and slices of ``slice_rows`` of them where there are more, as
    one load has one file date; one row per slice carries the last attributes, the sum of
    changes and the first start date over to its neighbours.
    """
    base = current.select(
        *ROW_COLUMNS, "eff_start_date", "version_num", F.lit(0).alias("_turn")
    )
    fresh = incoming.select(*ROW_COLUMNS).withColumns({
        "email": F.lower(F.trim("email")),
        "eff_start_date": F.col("file_date"),
        "version_num": F.lit(None).cast("int"),
        "_turn": F.lit(1),
    })
    rows = base.unionByName(fresh).filter("master_patient_id is not null")
    key = ["master_patient_id"]
    sliced = stored(
        rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.bool_or(F.col("eff_start_date").isNull()).alias("_undated"))
        .filter((F.col("_n") > slice_rows) | F.col("_undated")).select(*key), "sliced-prospects")
    if sliced.isEmpty():
        numbered = _numbered_whole(rows)
    else:
        whole = rows.join(sliced, key, "left_anti")
        numbered = _numbered_whole(whole).unionByName(_numbered_sliced(rows.join(sliced, key, "left_semi"), slice_rows))
    return (
        numbered.withColumn("version_num", F.col("_version").cast("int"))
        .withColumn("is_current", F.col("_next_start").isNull())
        .withColumn("eff_end_date", F.coalesce("_next_start", F.lit(fv.OPEN_END).cast("date")))
        .withColumn("dq_passed", F.lit(True))
        .withColumn("is_new", F.col("_turn") == 1)
        .select(*ROW_COLUMNS, *VERSION_COLUMNS, "is_new")
    )
