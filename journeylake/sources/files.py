"""CSV readers for leads and event exports, batch and stream alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.columns import rounded_int
from .layouts import GENERIC_WIDTH, LAYOUTS, LEAD_COLUMNS, LEAD_FILE_PATTERN, Layout


def file_name() -> Column:
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)


def file_timestamp(name: Column | str) -> Column:
    """Time in a file name: …YYYYMMDD_HHMMSS.ext, else …YYYYMMDD_HHMM.ext, else null."""
    name = F.col(name) if isinstance(name, str) else name
    seconds = F.regexp_extract(name, r"(\d{8}_\d{6})\.[^.]+$", 1)
    minutes = F.regexp_extract(name, r"(\d{8}_\d{4})\.[^.]+$", 1)
    return F.coalesce(
        F.try_to_timestamp(seconds, F.lit("yyyyMMdd_HHmmss")),
        F.try_to_timestamp(minutes, F.lit("yyyyMMdd_HHmm")),
    ).cast("timestamp_ntz")


def _nulls_as_null(c: str) -> Column:
    """Empty and the words NULL/null count as null; the CSV reader handles one spelling only."""
    return F.when(~F.col(c).isin("", "NULL", "null"), F.col(c))


def with_row_numbers(df: DataFrame) -> DataFrame:
    """The row's number within its file, from 1, the same in every load of the file.

    A task reads a split of a file in order, so rows are numbered within the split and the rows
    of the file's earlier splits are added: one small row per split, no shuffle of the load."""
    if "_source_block" not in df.columns:
        return df.withColumn("_source_row_number", F.monotonically_increasing_id())
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    split = ["_source_path", "_source_block"]
    sizes = placed.groupBy(*split).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("_source_path").orderBy("_source_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*split, (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return placed.join(starts, split).withColumn("_source_row_number", F.col("_place") + F.col("_shift")).drop(
        "_place", "_shift", "_source_block")


def _with_lineage(df: DataFrame, columns: list[Column], streaming: bool) -> DataFrame:
    """Adds file path and name, load time and row numbers. A stream cannot number rows;
    its micro-batches do (`with_row_numbers`)."""
    out = df.select(
        *columns,
        F.col("_metadata.file_path").alias("_source_path"),
        F.col("_metadata.file_block_start").alias("_source_block"),
        file_name().alias("_source_file_name"),
        F.current_timestamp().cast("timestamp_ntz").alias("_loaded_at"),
    )
    return out if streaming else with_row_numbers(out)


def read_lead_csv(spark: SparkSession, path: str, streaming: bool = False, pattern: str = LEAD_FILE_PATTERN) -> DataFrame:
    """Lead files: fourteen positional text columns below a header.

    Rows with fewer columns are filled with nulls and longer rows cut, as the loader this
    follows continues past bad rows; rows that cannot be read at all are dropped.
    """
    reader = spark.readStream if streaming else spark.read
    raw = (
        reader.schema(", ".join(f"{c} string" for c in LEAD_COLUMNS))
        .option("header", True).option("enforceSchema", True)
        .option("quote", '"').option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", pattern)
        .csv(path)
    )
    return _with_lineage(raw, [_nulls_as_null(c).alias(c) for c in LEAD_COLUMNS], streaming)


def _layout_columns(layout: Layout) -> list[Column]:
    out = []
    for name, source in layout.columns:
        if source is None:
            c = F.lit(None).cast("string")
        elif isinstance(source, str):
            c = F.lit(source[1:])
        else:
            c = F.trim(F.col(f"c{source}"))
            c = F.when(~c.isin("", "NULL", "null"), c)
            if name in layout.rtrim:
                c = F.rtrim(c)
            if name in layout.integers:
                c = rounded_int(c)
        out.append(c.alias(name))
    return out


def _positional(
    spark: SparkSession, path: str, width: int, encoding: str, streaming: bool, strict: bool, pattern: str | None
) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    reader = (
        reader.schema(", ".join(f"c{i} string" for i in range(1, width + 1)))
        .option("header", True).option("enforceSchema", True)
        .option("quote", '"').option("escape", '"')
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
    )
    if encoding.upper().startswith("UTF-16"):
        # UTF-16 rows can only be found by reading a file as a whole.
        reader = reader.option("multiLine", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.csv(path)


def read_event_csv(
    spark: SparkSession, path: str, entity: str, encoding: str = "UTF-16", streaming: bool = False,
    layout: Layout | None = None, strict: bool = False, pattern: str | None = None,
) -> DataFrame:
    """Event export files of one entity, re-mapped by position and trimmed.

    The default tolerates rows of another width, as the exports' file format does;
    ``strict`` makes any such row fail the load.
    """
    layout = layout or LAYOUTS[entity]
    raw = _positional(spark, path, layout.width, encoding, streaming, strict, pattern)
    return _with_lineage(raw, _layout_columns(layout), streaming)


def read_generic(spark: SparkSession, path: str, encoding: str = "UTF-16", streaming: bool = False,
                 pattern: str | None = None) -> DataFrame:
    """Files of unknown layout: up to fifty cells as one array."""
    raw = _positional(spark, path, GENERIC_WIDTH, encoding, streaming, False, pattern)
    cells = F.array(*[F.nullif(F.trim(F.col(f"c{i}")), F.lit("")) for i in range(1, GENERIC_WIDTH + 1)])
    return _with_lineage(raw, [cells.alias("raw_row")], streaming)


def empty_events(spark: SparkSession, entity: str) -> DataFrame:
    """An entity without a configured source."""
    layout = LAYOUTS[entity]
    fields = [f"{n} {'int' if n in layout.integers else 'string'}" for n, _ in layout.columns]
    fields += ["_source_path string", "_source_file_name string", "_loaded_at timestamp_ntz", "_source_row_number bigint"]
    return spark.createDataFrame([], ", ".join(fields))


def export_csv(df: DataFrame, path: str, single_file: bool = False, encoding: str = "UTF-8") -> None:
    """CSV with header and quotes, uncompressed. One file only on request: it funnels the
    whole export through one task."""
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
        .option("compression", "none").option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
