"""Tables addressed by path, one folder per snapshot.

A write goes to a new folder and never touches the one being read; a snapshot counts only once
its `_SUCCESS` marker is there, so a job that dies half way leaves the table as it was.

A table that batches are merged into is divided into buckets by a hash of its key. A merge reads and
writes only the buckets its batch has keys of: they go to a patch, a folder numbered like a snapshot.
The table is then, of each bucket, what the newest complete patch after the newest snapshot holds, or
the snapshot itself. Folder names say all of it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from jobmeld.session import scratch_path
from jobmeld.sources.schema import empty_like

PREFIX, PATCH = "snapshot=", "patch="
BUCKET = "_bucket"


class SnapshotStore:
    """Every snapshot stays until `expire` is called, so a frame read earlier can still be used.

    `buckets` is the number of buckets of tables made from now on; a table keeps the one it has.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", buckets: int = 32):
        self.spark, self.root, self.fmt, self.buckets = spark, root.rstrip("/"), fmt, buckets

    # ---- paths -------------------------------------------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _children(self, path: str) -> list[str]:
        fs, base = self._fs(path)
        if not fs.exists(base):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(base))

    def _numbers(self, name: str, prefix: str = PREFIX) -> list[int]:
        return [int(n[len(prefix):]) for n in self._children(f"{self.root}/{name}") if n.startswith(prefix)]

    def _next(self, name: str) -> int:
        return max(self._numbers(name) + self._numbers(name, PATCH), default=0) + 1

    def _path(self, name: str, number: int, prefix: str = PREFIX) -> str:
        return f"{self.root}/{name}/{prefix}{number:08d}"

    def _complete(self, name: str, prefix: str = PREFIX) -> list[int]:
        out = []
        for n in self._numbers(name, prefix):
            fs, marker = self._fs(self._path(name, n, prefix) + "/_SUCCESS")
            if fs.exists(marker):
                out.append(n)
        return out

    def _layers(self, name: str) -> list[str]:
        """The newest complete snapshot and the complete patches after it, newest first."""
        done = self._complete(name)
        if not done:
            raise FileNotFoundError(f"no snapshot of {name} below {self.root}")
        patches = [n for n in self._complete(name, PATCH) if n > done[-1]]
        return [self._path(name, n, PATCH) for n in reversed(patches)] + [self._path(name, done[-1])]

    def bucket_folders(self, name: str) -> dict[str, str]:
        """Of a table in buckets, the folder that holds each one now, by the bucket's label; of another table, none."""
        found: dict[str, str] = {}
        for layer in self._layers(name):
            for child in self._children(layer):
                if child.startswith(f"{BUCKET}="):
                    found.setdefault(child[len(BUCKET) + 1:], f"{layer}/{child}")
        return found

    # ---- reads -------------------------------------------------------------------------------
    def exists(self, name: str) -> bool:
        """Whether the table has a complete snapshot (SRC5)."""
        return bool(self._complete(name))

    def read(self, name: str, columns: Sequence[str] | None = None) -> DataFrame:
        """The newest state of the table (SRC3); `columns` prunes the scan (SRC4)."""
        folders = self.bucket_folders(name)
        df = self._load(name, list(folders.values())) if folders else self.spark.read.format(self.fmt).load(self._layers(name)[0])
        return df.select(*columns) if columns else df

    def _load(self, name: str, folders: Sequence[str]) -> DataFrame:
        """Some buckets, with the columns of the newest: what merges add later, earlier files lack."""
        schema = self._schema(name)
        if not folders:
            return empty_like(self.spark, schema)
        return self.spark.read.format(self.fmt).schema(schema).load(list(folders))

    def read_touched(self, name: str, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The buckets of the table in which keys of `batch` belong; reads the whole of a table that has none."""
        folders = self.bucket_folders(name)
        if not folders:
            return self.read(name)
        labels = batch.select(_bucket(keys, self._bucket_count(name)).alias(BUCKET)).distinct()
        # at most one row per bucket
        return self._load(name, [folders[r[0]] for r in labels.collect() if r[0] in folders])

    def _schema(self, name: str) -> T.StructType:
        schema = self.spark.read.format(self.fmt).load(self._layers(name)[0]).schema
        return T.StructType([f for f in schema.fields if f.name != BUCKET])

    def register(self, name: str, view: str | None = None) -> str:
        """Make the newest state visible to `spark.sql` (SRC7)."""
        view = view or name.replace("/", "_")
        self.read(name).createOrReplaceTempView(view)
        return view

    # ---- writes ------------------------------------------------------------------------------
    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace the table, schema included (SNK1, SNK2); returns the new snapshot."""
        number = self._next(name)
        writer = self._writer(df).mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(self._path(name, number))
        if partition_by and not self._has_data(name, number):
            # partitions of no rows leave no file, and so no schema to read back
            return self.write(empty_like(self.spark, T.StructType([f for f in df.schema.fields if f.name != BUCKET])), name)
        return self.read(name)

    def _writer(self, df: DataFrame):
        # texts take two thirds of the room that Parquet's own choice leaves them
        writer = df.write.format(self.fmt)
        return writer.option("compression", "zstd") if self.fmt == "parquet" else writer

    def _has_data(self, name: str, number: int) -> bool:
        return any(n != "_SUCCESS" for n in self._children(self._path(name, number)))

    def write_buckets(self, df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
        """Replace the table by `df` in buckets of `keys`, so that batches can be merged into it later."""
        return self.write(_dealt(df, keys, self._bucket_count(name)), name, [BUCKET])

    def rewrite(self, name: str, how: Callable[[DataFrame], DataFrame], keys: Sequence[str]) -> DataFrame:
        """Replace a table by `how` of it, a change row by row that leaves the keys as they are.

        Rows of a table in buckets stay in theirs: a task writes what it read, and nothing is shuffled.
        """
        if not self.bucket_folders(name):
            return self.write_buckets(how(self.read(name)), name, keys)
        rows = how(self.read(name))
        return self.write(rows.withColumn(BUCKET, _bucket(keys, self._bucket_count(name))), name, [BUCKET])

    def _bucket_count(self, name: str) -> int:
        labels = self.bucket_folders(name) if self.exists(name) else {}
        return int(next(iter(labels)).partition("of")[2]) if labels else self.buckets

    def merge(
        self,
        name: str,
        batch: DataFrame,
        keys: Sequence[str],
        how: Callable[[DataFrame, DataFrame], DataFrame],
        start: DataFrame | None = None,
    ) -> DataFrame:
        """Merge a batch by key, reading and writing the buckets it touches only; returns the whole table.

        `how(dest, batch)` gives the merged rows of the rows it gets; it must take and leave the keys as they are, so
        that rows of other buckets have no part in it. The batch is written aside once, as its keys are read before
        its rows are. A table that is not there starts as `start`, or empty with the batch's columns, and takes
        the batch as it comes; one that is not in buckets yet is rewritten whole, once. A batch without rows writes a table that is not there, else nothing.
        """
        count = self._bucket_count(name)
        if not self.exists(name):
            dest = start if start is not None else empty_like(self.spark, batch.schema)
            return self.write_buckets(how(dest, batch), name, keys)
        aside = scratch_path(self.spark, "batch")
        batch.select("*", _bucket(keys, count).alias(BUCKET)).write.option("compression", "zstd").parquet(aside)
        rows = self.spark.read.parquet(aside)
        # at most one row per bucket
        touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]
        folders = self.bucket_folders(name)
        if not folders:
            out = self.write_buckets(how(self.read(name), rows.drop(BUCKET)), name, keys)
        elif touched:
            dest = self._load(name, [folders[t] for t in touched if t in folders])
            merged = _dealt(how(dest, rows.drop(BUCKET)), keys, count)
            # a patch of all buckets is a snapshot, and those before it are read no more
            prefix = PREFIX if set(folders) <= set(touched) else PATCH
            path = self._path(name, self._next(name), prefix)
            self._writer(merged).partitionBy(BUCKET).save(path)
            out = self.read(name)
        else:
            out = self.read(name)
        self.drop_folders([aside])
        return out

    def create(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """First write; refuses when the table is there already (SNK3)."""
        if self.exists(name):
            raise FileExistsError(f"{name} exists below {self.root}")
        return self.write(df, name, partition_by)

    def create_if_absent(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """An empty table with the schema of `df`, all columns nullable, unless it exists (SC1)."""
        if not self.exists(name):
            self.write(empty_like(self.spark, df.schema), name, partition_by)
        return self.read(name)

    def folders(self, path: str) -> list[str]:
        """Complete output folders directly below `path`."""
        fs, base = self._fs(path)
        if not fs.exists(base):
            return []
        found = sorted(s.getPath().toString() for s in fs.listStatus(base) if s.isDirectory())
        return [f for f in found if fs.exists(self._fs(f + "/_SUCCESS")[1])]

    def drop_folders(self, paths: Sequence[str]) -> None:
        for path in paths:
            fs, p = self._fs(path)
            fs.delete(p, True)

    def expire(self, name: str, age_seconds: float) -> int:
        """Delete snapshots that a newer one replaced at least `age_seconds` ago; returns how many went.

        Never called by a write. The age must exceed the longest time a frame stays in use.
        """
        done = self._complete(name)
        limit = time.time() - age_seconds
        old = [n for n, newer in zip(done, done[1:]) if self._finished(name, newer) <= limit]
        # patches count up to the next snapshot
        ended = [n for n in done[1:] if self._finished(name, n) <= limit]
        patches = [n for n in self._complete(name, PATCH) if ended and n < ended[-1]]
        self.drop_folders([self._path(name, n) for n in old] + [self._path(name, n, PATCH) for n in patches])
        return len(old)

    def _finished(self, name: str, number: int) -> float:
        fs, marker = self._fs(self._path(name, number) + "/_SUCCESS")
        return fs.getFileStatus(marker).getModificationTime() / 1000


def _bucket(keys: Sequence[str], count: int) -> Column:
    """A row's bucket, as `7of32`; keys of the same text share it, whatever their type."""
    number = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(count))
    return F.concat(number.cast("string"), F.lit(f"of{count}"))


def _dealt(df: DataFrame, keys: Sequence[str], count: int) -> DataFrame:
    """Rows with their bucket, those of a bucket together, so that it is one file, or several where it is large."""
    return df.withColumn(BUCKET, _bucket(keys, count)).hint("rebalance", BUCKET)


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether `path` can be read as a table (SRC5), for tables outside a store."""
    try:
        spark.read.format(fmt).load(path)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
