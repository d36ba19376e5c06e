"""Tables written to the cluster's shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_LOCAL: dict[str, str] = {}
_SCOPE: ContextVar[list[DataFrame] | None] = ContextVar("scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, a temporary one (local master) or the warehouse."""
    if found := spark.conf.get("spark.checkpoint.dir", ""):
        return found.rstrip("/")
    if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        return _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="ledgerlake-"))
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/ledgerlake_scratch"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Writes df as Parquet in the shared folder and returns the table as read back, with the same schema."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])).parquet(path)
    out._ledgerlake_path = path
    if (scope := _SCOPE.get()) is not None:
        scope.append(out)
    return out


def discard(df: DataFrame) -> None:
    """Deletes the files of a table that materialize() wrote, once nothing reads it any more."""
    path = getattr(df, "_ledgerlake_path", None)
    if path:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


@contextmanager
def settings(spark: SparkSession, **values: object) -> Iterator[None]:
    """Session settings (dots as double underscores) for the jobs that run inside; what was set before comes back."""
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def frugal(spark: SparkSession, batch: int = 4 << 20):
    """Settings for operators that write tables between many jobs.

    Arrow batches hold at most about `batch` bytes, whatever the length of their rows: a batch is in the JVM and in Python
    at once, and Spark's own bounds (10,000 rows, 256 MB) let long rows fill an executor beside its heap. The shuffle files
    of a job are deleted when it ends: the table that it has written stands for them."""
    return settings(spark, spark__sql__execution__arrow__maxBytesPerBatch=batch, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A scope whose tables are deleted at its end. What it gives writes a result as a table that outlives the scope:

        with scratch() as keep:
            return keep(some_operator(df))
    """
    tables: list[DataFrame] = []
    kept: list[DataFrame] = []
    token = _SCOPE.set(tables)

    def keep(df: DataFrame, name: str = "result") -> DataFrame:
        kept.append(materialize(df, name))
        return kept[-1]

    try:
        yield keep
    finally:
        _SCOPE.reset(token)
        for df in tables:
            if not any(df is k for k in kept):
                discard(df)
        if (outer := _SCOPE.get()) is not None:
            outer.extend(kept)
