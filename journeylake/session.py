"""Session defaults and the two ways this library cuts lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "journeylake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for.

    Shuffle partition counts are left to adaptive execution; ``conf`` overrides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    without that setting gets a temporary folder of its own, because executors on
    other machines could not read one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="journeylake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise once in the shared folder, so later branches read the same rows."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written once to the shared folder and read back: unlike a checkpoint's, its size is known
    from its files, so that joins with few rows are planned as broadcasts."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fixed_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A small literal table. It plans as a local relation of known size, so no Python
    rows are shipped and Spark can broadcast it on its own. ``rows`` are program constants."""
    def literal(v: object) -> str:
        if v is None:
            return "null"
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(v).lower() if isinstance(v, bool) else str(v)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    casts = ", ".join(
        f"cast(col{i + 1} as {kind}) as {name}"
        for i, (name, kind) in enumerate(part.split() for part in schema.split(","))
    )
    return spark.sql(f"select {casts} from values {body}")
