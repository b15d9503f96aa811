"""Shared pieces: input columns, the shared folder, written intermediate tables."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.shipping import ship

#: The words of a text: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Spark's setting by which the shuffle files of a query are removed at its end.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: list[tuple[SparkSession, str]] = []
#: Of the innermost scratch() that is open: what was written in it.
_scratch: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("scratch", default=None)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text of `docs`, nothing else; a null text becomes empty."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode, where that is unset, one of our own."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/tessera-{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    if (held := _scratch.get()) is not None:
        held.append((spark, path))
    return path


def stash(df: DataFrame, name: str, by: str | None = None, **options: str) -> DataFrame:
    """Write `df` to the shared folder, in folders for each value of `by`, and read it again: lineage ends here, and a lost executor costs nothing of it."""
    path = new_path(df.sparkSession, name)
    shuffles_go(df.sparkSession)
    df.write.options(**options).parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch() -> Iterator[Callable[..., DataFrame]]:
    """Tables that stash() writes in this block go at its end, but for those written by what it gives, which is stash() for results."""
    held: list[tuple[SparkSession, str]] = []
    outer = _scratch.get()

    def keep(df: DataFrame, name: str, **how: str) -> DataFrame:
        out = stash(df, name, **how)
        own = held.pop()
        if outer is not None:
            outer.append(own)
        return out

    token = _scratch.set(held)
    try:
        yield keep
    finally:
        _scratch.reset(token)
        for own in held:
            deleted(*own)


def shuffles_go(spark: SparkSession) -> None:
    """A query's shuffle files go when it ends, not when the driver happens to collect its garbage: what is needed again is stored.

    A setting that the session has been given is left as it is.
    """
    if SHUFFLES_GO not in spark.conf.getAll:
        spark.conf.set(SHUFFLES_GO, "true")


def deleted(session: SparkSession, path: str) -> None:
    if (session, path) in _written:
        _written.remove((session, path))
    try:
        where = session._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(session._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session has ended; the folder goes with it
        pass


def forget(spark: SparkSession | None = None) -> None:
    """Delete the tables that stash() wrote; call it once their results are stored. Also runs when Python exits."""
    for session, path in list(_written):
        if spark is None or session is spark:
            deleted(session, path)


atexit.register(forget)


def arrow_batches(spark: SparkSession, rows: int = 512, mb: int = 8) -> None:
    """Bound what one Arrow batch of whole texts can take in a Python worker, which gets this package.

    The settings are read when a plan runs, after the operator has returned, so they stay; one that the session has
    been given a value for is left as it is.
    """
    ship(spark)
    given = spark.conf.getAll
    for name, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows)), ("spark.sql.execution.arrow.maxBytesPerBatch", f"{mb}m")):
        if name not in given:
            spark.conf.set(name, value)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An Arrow function that gives its free memory back when a task ends: workers live on and would keep it."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return wrapped


def unused(df: DataFrame, name: str) -> str:
    """`name`, made longer until `df` has no column of it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def input_bytes(df: DataFrame) -> int:
    """What the optimizer takes the plan's input to be, in bytes, 0 if it can't tell: sizes partitions, never decides on rows."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else 0


def tasks_for(df: DataFrame, mb: int) -> int:
    """Partitions of about `mb` MB of stored input, and no fewer than the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(100_000, input_bytes(df) // (mb << 20) + 1))
