"""Read-only SQL on registered tables, column discovery and table profiles."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Leaves of a plan that reach no data but their own.
_OWN_DATA = {"OneRowRelation", "LocalRelation", "Range", "CTERelationRef", "UnionLoopRef"}
#: Functions that call any method of the JVM.
_JVM_CALLS = {"reflect", "java_method", "try_reflect"}


def _each(items) -> Iterator:
    it = items.iterator()
    while it.hasNext():
        yield it.next()


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _nodes(plan) -> Iterator:
    """A plan's nodes, those of its subqueries and common tables too. What stands behind a
    registered view is its owner's business."""
    yield plan
    if _kind(plan) != "View":
        for part in (plan.children(), plan.innerChildren(), plan.subqueries()):
            for child in _each(part):
                if hasattr(child, "subqueries"):
                    yield from _nodes(child)


def _calls(expression) -> Iterator[str]:
    if _kind(expression) == "UnresolvedFunction":
        yield from (str(name).lower() for name in list(_each(expression.nameParts()))[-1:])
    if _kind(expression) == "CallMethodViaReflection":
        yield "reflect"
    for child in _each(expression.children()):
        yield from _calls(child)


def check_read_only(spark: SparkSession, statement: str) -> None:
    """Raises unless the statement only reads registered tables.

    Spark's own parser and analyser say what it is, so comments, quotes and literals mean what they
    mean to Spark; nothing is run. Refused are commands other than SHOW and DESCRIBE, relations
    that are neither tables of the catalog nor registered views (files by their path), and calls of
    JVM methods."""
    state = spark._jsparkSession.sessionState()
    try:
        parsed = state.sqlParser().parsePlan(statement)
    except ParseException as exc:
        raise ValueError(f"not one SQL statement: {exc}") from exc
    # Before the analyser, which may evaluate constants and open files.
    for node in _nodes(parsed):
        if _kind(node) == "UnresolvedRelation":
            parts = [str(part) for part in _each(node.multipartIdentifier())]
            if len(parts) > 1 and not spark.catalog.tableExists(".".join("`" + part.replace("`", "``") + "`" for part in parts)):
                raise ValueError("only registered tables are allowed")
        for expression in _each(node.expressions()):
            if not _JVM_CALLS.isdisjoint(_calls(expression)):
                raise ValueError("only SQL functions are allowed, not: calls of JVM methods")
    if _kind(parsed).startswith(("Show", "Describe")):
        return
    command = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.plans.logical.Command")
    for node in _nodes(parsed):
        if command.isInstance(node) or _kind(node).startswith(("InsertInto", "Create", "Replace", "Call")):
            raise ValueError(f"only reading statements are allowed, not: {_kind(node)}")
    for node in _nodes(state.executePlan(parsed, spark._jvm.org.apache.spark.sql.execution.CommandExecutionMode.SKIP()).analyzed()):
        if command.isInstance(node):
            raise ValueError(f"only reading statements are allowed, not: {_kind(node)}")
        if node.children().isEmpty() and _kind(node) not in _OWN_DATA | {"View"}:
            if not (_kind(node) in ("LogicalRelation", "HiveTableRelation") and _of_catalog(node)):
                raise ValueError("only registered tables are allowed")
        for expression in _each(node.expressions()):
            if not _JVM_CALLS.isdisjoint(_calls(expression)):
                raise ValueError("only SQL functions are allowed, not: calls of JVM methods")


def _of_catalog(relation) -> bool:
    return _kind(relation) == "HiveTableRelation" or relation.catalogTable().isDefined()


def run_sql(spark: SparkSession, statement: str, max_rows: int | None = None) -> DataFrame:
    check_read_only(spark, statement)
    out = spark.sql(statement)
    return out if max_rows is None else out.limit(max_rows)


def register(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def columns_of(spark: SparkSession, table: str) -> list[str]:
    """Column names in order; empty when the table is missing."""
    if not spark.catalog.tableExists(table):
        return []
    return [c.name for c in spark.catalog.listColumns(table)]


def table_profile(tables: Mapping[str, DataFrame | None], sample: int = 5) -> DataFrame:
    """One row per table: columns, row count, a few rows as JSON, or a note if missing."""
    schema = "table_name string, columns string, row_count bigint, sample array<string>, note string"

    def one(name: str, df: DataFrame) -> DataFrame:
        rows = df.limit(sample).select(F.to_json(F.struct(*df.columns)).alias("j")).agg(F.collect_list("j").alias("s"))
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(", ".join(df.columns)).alias("columns"), "row_count",
            rows.scalar().alias("sample"), F.lit(None).cast("string").alias("note"),
        )

    present = [one(n, df) for n, df in tables.items() if df is not None]
    missing = [(n, None, None, None, "Table not accessible or empty.") for n, df in tables.items() if df is None]
    spark = next((df.sparkSession for df in tables.values() if df is not None), SparkSession.active())
    parts = present + ([spark.createDataFrame(missing, schema)] if missing else [])
    return reduce(DataFrame.unionByName, parts)
