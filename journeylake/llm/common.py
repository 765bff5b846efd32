"""Helpers that several operators share: written steps, text batches, worker-long caches."""

from __future__ import annotations

import ctypes
import os
import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Text bytes that one vectorised step works on.
SLICE_BYTES = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches, from ``spark.checkpoint.dir``. Only where the
    session has none (tests, a notebook) one is made and set."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and read again by
    every later branch, also after an executor is lost."""
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents_of(docs: DataFrame, *more: str) -> DataFrame:
    """Id and text, null text as empty; nothing else of the table travels."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column is called that in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == 0


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, so that the tasks it runs one after
    another share what they have computed. Only for values that follow from their key."""
    module = sys.modules.setdefault("_llm_worker_caches", types.ModuleType("_llm_worker_caches"))
    return module.__dict__.setdefault(name, {})


def drop_worker_caches() -> None:
    """Frees what the tasks of other operators have left in this worker."""
    sys.modules.pop("_llm_worker_caches", None)


def free_memory() -> None:
    """Gives back to the system what this worker's earlier tasks have freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array in one piece and the n + 1 offsets into them."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``most`` bytes each; a longer text comes alone."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        yield start, min(stop, n)
        start = min(stop, n)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform doubles in (0, 1) from 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def column(values, kind) -> pa.Array:
    return pa.array(values, kind)
