"""Tables as versioned parquet folders.

``root/layer/table/v00000001/<batch>/part-…``: a batch folder counts once Spark's job
commit has put its ``_SUCCESS`` mark there, and the highest version with a finished batch
is the table. Appends add a batch folder, replacements start a new version; readers of the
old version are undisturbed. A step whose batch is already finished is skipped, so a
retried batch repeats nothing. One writer per table is assumed.

Batches may be written in parts (``_batch=<batch>/_part=<value>``), by month, day or hash
bucket of a key; `read` then opens the parts asked for only. In a table written by
`merge_parts` a batch holds whole parts, and the newest one of each part counts: a small
batch reads and writes the parts of its keys, however large the table is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

PART, BATCH = "_part", "_batch"
#: Every layer keeps its rows again, so their size counts for more than the time to pack them.
CODEC = "zstd"


def values_of(rows: DataFrame, part: Column) -> list:
    """The parts that rows fall into: as many as a batch has days, months or buckets."""
    return [r[0] for r in rows.select(part.cast("string")).distinct().collect()]


class Lake:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        # Schemas of tables written by this object, which saves a footer job per read.
        self._schemas: dict[str, StructType] = {}

    def bucket(self, key: str) -> Column:
        """Hash bucket of a key; the number of buckets must stay with the lake."""
        return F.pmod(F.xxhash64(key), F.lit(self.buckets))

    # --- folders -----------------------------------------------------------

    def _fs(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), jpath

    def _children(self, path: str) -> list[str]:
        fs, jpath = self._fs(path)
        if not fs.exists(jpath):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory())

    def _finished(self, path: str) -> bool:
        fs, jpath = self._fs(f"{path}/_SUCCESS")
        return fs.exists(jpath)

    def _merged(self, name: str) -> list[tuple[str, str]]:
        """Finished (folder, batch) of a table written by `merge_parts`, oldest first."""
        folder = f"{self.root}/{name}/parts"
        return [(f"{folder}/{b}", b.split("-", 1)[1]) for b in self._children(folder) if self._finished(f"{folder}/{b}")]

    def _batches(self, name: str) -> tuple[int, list[str]]:
        """Current version number (0 for none) and its finished batches."""
        for version in reversed([v for v in self._children(f"{self.root}/{name}") if v != "parts"]):
            folder = f"{self.root}/{name}/{version}"
            done = [b.removeprefix(f"{BATCH}=") for b in self._children(folder) if self._finished(f"{folder}/{b}")]
            if done:
                return int(version[1:]), done
        return 0, []

    # --- reading -------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return bool(self._batches(name)[1] or self._merged(name))

    def has_batch(self, name: str, batch: str) -> bool:
        return batch in self._batches(name)[1] or batch in [b for _, b in self._merged(name)]

    def read(self, name: str, parts: Iterable | None = None) -> DataFrame:
        """The table, or of a table in parts only those named."""
        merged = self._merged(name)
        if merged:
            newest = {p: f"{folder}/{p}" for folder, _ in merged for p in self._children(folder) if p.startswith(PART)}
            wanted = newest if parts is None else {f"{PART}={p}" for p in parts} & newest.keys()
            # Without a part of its own, a batch still needs the table's schema.
            paths = [newest[p] for p in sorted(wanted)] or list(newest.values())[:1]
            df = self._load(name, f"{self.root}/{name}/parts", *paths)
            return df if wanted else df.limit(0)
        version, batches = self._batches(name)
        if not batches:
            raise LookupError(f"no table {name} below {self.root}")
        base = f"{self.root}/{name}/v{version:08d}"
        return self._load(name, base, *[self._folder(base, b) for b in batches], parts=parts)

    def _folder(self, base: str, batch: str) -> str:
        return f"{base}/{BATCH}={batch}" if self._finished(f"{base}/{BATCH}={batch}") else f"{base}/{batch}"

    def _load(self, name: str, base: str, *folders: str, parts: Iterable | None = None) -> DataFrame:
        known = self._schemas.get(name)
        reader = self.spark.read if known is None else self.spark.read.schema(known)
        if any(f"/{BATCH}=" in f for f in folders):
            reader = reader.option("basePath", base)
        df = reader.parquet(*folders)
        if parts is not None and PART in df.columns:
            named = [p for p in parts if p is not None]
            keep = F.col(PART).cast("string").isin(named) if named else F.lit(False)
            df = df.filter(keep | F.col(PART).isNull() if None in list(parts) else keep)
        return df.drop(PART, BATCH)

    def _write(self, name: str, folder: str, df: DataFrame, part: Column | None = None, by_part: bool = False,
               late: Callable[[DataFrame], DataFrame] | None = None) -> int:
        """Writes and returns the rows written, from the footers of the files. (Metrics observed
        on the way are lost where the optimiser finds a frame to be empty.)"""
        if part is None:
            df.write.mode("overwrite").option("compression", CODEC).parquet(folder)
        else:
            # Rows of a part come together, in more than one file where they are many.
            df = df.withColumn(PART, part.cast("string"))
            together = df if by_part else df.hint("rebalance", F.col(PART))
            df = together if late is None else late(together)
            df.write.mode("overwrite").option("compression", CODEC).partitionBy(PART).parquet(folder)
        self._schemas[name] = df.schema
        return self._load(name, folder.rsplit("/", 1)[0], folder).count()

    def read_or_none(self, name: str, parts: Iterable | None = None) -> DataFrame | None:
        """The table; None where there is none or where the parts named hold no rows, so that
        what is compared with it need not be shuffled to meet nothing."""
        if not self.exists(name):
            return None
        df = self.read(name, parts)
        return None if parts is not None and df.isEmpty() else df

    def read_batch(self, name: str, batch: str) -> DataFrame:
        for folder, done in reversed(self._merged(name)):
            if done == batch:
                return self._load(name, f"{self.root}/{name}/parts", folder)
        version, batches = self._batches(name)
        if batch not in batches:
            raise LookupError(f"no batch {batch} in {name}")
        base = f"{self.root}/{name}/v{version:08d}"
        return self._load(name, base, self._folder(base, batch))

    # --- writing -------------------------------------------------------------

    def append(self, name: str, batch: str, make: Callable[[], DataFrame], part: Column | None = None,
               by_part: bool = False, late: Callable[[DataFrame], DataFrame] | None = None) -> int:
        """Writes ``make()`` as one batch; returns its row count, of a batch that is there already
        from the footers of its files. ``by_part`` tells that the rows come straight from a table
        with the same parts and lie together already. ``late`` adds columns that follow from
        others when the rows of a part have come together, so that they are not shuffled."""
        version, batches = self._batches(name)
        if batch in batches:
            return self.read_batch(name, batch).count()
        folder = batch if part is None else f"{BATCH}={batch}"
        return self._write(name, f"{self.root}/{name}/v{max(version, 1):08d}/{folder}", make(), part, by_part, late)

    def replace(self, name: str, batch: str, make: Callable[[], DataFrame]) -> int:
        """Writes ``make()`` as the whole table in a new version; returns its row count. A batch
        that an earlier version already holds has been taken in and is not put on top again."""
        version, batches = self._batches(name)
        if batch in batches or any(self._finished(f"{self.root}/{name}/v{v:08d}/{batch}") for v in range(1, version)):
            return self.read(name).count()
        return self._write(name, f"{self.root}/{name}/v{version + 1:08d}/{batch}", make())

    def merge_parts(self, name: str, batch: str, make: Callable[[], DataFrame], part: Column) -> int:
        """Writes ``make()``, the new content of every part it touches and nothing else; returns
        its row count. Other parts stay as earlier batches left them."""
        merged = self._merged(name)
        if batch in [done for _, done in merged]:
            return self.read_batch(name, batch).count()
        # Numbered after unfinished tries too, so that order is the order of starting.
        n = len(self._children(f"{self.root}/{name}/parts"))
        return self._write(name, f"{self.root}/{name}/parts/{BATCH}={n:08d}-{batch}", make(), part)

    def compact(self, name: str, batch: str, partitions: int | None = None) -> None:
        """Rewrites an appended table with fewer, larger files. Run it between batches."""
        df = self.read(name)
        self.replace(name, batch, lambda: df.coalesce(partitions) if partitions else df)
