"""Tables in a folder that every executor can read.

A layer that several others read is written once and read back: a lost executor then costs
a re-read of files and not a recomputation, and Spark knows the true size of every table
when it decides whether a join side is small enough to broadcast.
"""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from threading import Lock
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from reportstar.sinks.files import SmallFiles

# Error conditions of a table that is not there, or has no rows yet.
MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND")

# Layers are written once and read often: smaller files are worth a little more work than the default codec does.
CODEC = "zstd"

_local_folders: dict[str, str] = {}

# With it Spark deletes the shuffle files of an execution when that ends, and not when the driver happens to collect its
# garbage: until then the files of all layers would lie on disk side by side.
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: Counter[str] = Counter()
_found: dict[str, str | None] = {}
_lock = Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """For writes of tables that are read back: nobody reads their shuffle files again. Several threads may be in such a
    block; the last to leave puts the session's setting back."""
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        if not _freeing[session]:
            _found[session] = spark.conf.get(FREES_SHUFFLES, None)
            spark.conf.set(FREES_SHUFFLES, "true")
        _freeing[session] += 1
    try:
        yield
    finally:
        with _lock:
            _freeing[session] -= 1
            if not _freeing[session]:
                before = _found.pop(session)
                spark.conf.unset(FREES_SHUFFLES) if before is None else spark.conf.set(FREES_SHUFFLES, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir. Only a local session, where
    driver and executors share one disk, may fall back to a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="reportstar-")
    return _local_folders[context.applicationId]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to a fresh scratch table and read it back: values that a retry could
    compute differently (row positions) are fixed by it."""
    return df.sparkSession.read.schema(df.schema).parquet(_written(df))


@contextmanager
def scratch_table(df: DataFrame) -> Iterator[DataFrame]:
    """The same for as long as the block lasts; then the table is deleted."""
    path = _written(df)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        SmallFiles(df.sparkSession, path).delete("")


def _written(df: DataFrame) -> str:
    path = f"{shared_folder(df.sparkSession)}/scratch/{uuid.uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression=CODEC)
    return path


def _if_there(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in MISSING:
            return None
        raise


class Store(Protocol):
    """Where the layers of the model are kept."""

    spark: SparkSession

    def read(self, name: str) -> DataFrame: ...

    def read_if_exists(self, name: str) -> DataFrame | None: ...

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        """Full refresh; column changes are taken over. `df` must not read `name`."""
        ...

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Add rows; `df` may read the table it is appended to."""
        ...

    def extend(
        self, name: str, build: Callable[[DataFrame | None], DataFrame], partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Add the rows that `build` makes from the table so far (None: there is none)."""
        ...

    def drop(self, name: str) -> None:
        """Delete a scratch table, or one that nobody reads any more."""
        ...

    def publish(self) -> None:
        """The run is complete."""
        ...


class OneRunStore:
    """A store that knows one run at a time: what is written is what readers see, and nothing is taken over from a run
    that broke. `RunStore` keeps runs apart."""

    resumes = False

    def extend(
        self, name: str, build: Callable[[DataFrame | None], DataFrame], partition_by: Sequence[str] = ()
    ) -> DataFrame:
        return self.append(name, build(self.read_if_exists(name)), partition_by)

    def publish(self) -> None:
        pass


class TableStore(OneRunStore):
    """Named parquet tables under one folder."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or f"{shared_folder(spark)}/star-{uuid.uuid4().hex}").rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def read_if_exists(self, name: str) -> DataFrame | None:
        return _if_there(lambda: self.read(name))

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        with shuffles_freed(self.spark):
            df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(name), compression=CODEC)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        with shuffles_freed(self.spark):
            df.write.mode("append").partitionBy(*partition_by).parquet(self.path(name), compression=CODEC)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        SmallFiles(self.spark, self.root).delete(name)


class CatalogStore(OneRunStore):
    """Tables of a catalog schema. A provider with atomic replacement (Delta, Iceberg) gives
    readers the old or the new table; parquet tables are overwritten in place."""

    def __init__(self, spark: SparkSession, schema: str, provider: str = "parquet"):
        self.spark = spark
        self.schema = schema
        self.provider = provider

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.table(name))

    def read_if_exists(self, name: str) -> DataFrame | None:
        return _if_there(lambda: self.read(name))

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        with shuffles_freed(self.spark):
            if self.provider == "parquet":
                df.write.format("parquet").mode("overwrite").saveAsTable(self.table(name))
            else:
                df.writeTo(self.table(name)).using(self.provider).createOrReplace()
        return self.read(name)

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        writer = df.write.format(self.provider).mode("append").partitionBy(*partition_by)
        with shuffles_freed(self.spark):
            writer.saveAsTable(self.table(name))
        return self.read(name)

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table(name)}")

    def create_view(self, name: str, sql: str) -> None:
        """A view of the catalog, for every session that shares it."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.table(name)} AS {sql}")


def replace_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
