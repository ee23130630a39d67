"""Shared storage, lineage cuts and Arrow slicing for the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Text bytes that one vectorised step handles (a longer text is a step of its own).
STEP_BYTES = 1 << 20
#: At most so many ids (8 bytes each) go out as a broadcast; beyond, the join shuffles.
BROADCAST_IDS = 2_000_000


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application: they need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="cohortmark-"), "cohortmark"), "zip", os.path.dirname(top), os.path.basename(top))
    sc.addPyFile(name)
    _shipped.add(sc.applicationId)


#: In a worker: what operators keep from task to task, and how to give it up.
held: dict[str, Callable[[], None]] = {}


def give_up(keep: str | None) -> None:
    """Free what other operators keep: a worker serves one stage after another."""
    others = [k for k in held if k != keep]
    for k in others:
        held.pop(k)()
    if others:
        gc.collect()
        trim()


def trim() -> None:
    """Give memory that nothing uses back to the machine: a worker stays, idle, after its task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: the memory stays with the process
        return


def per_batch(df: DataFrame, step: Callable, schema: str, keep: str | None = None) -> DataFrame:
    """mapInArrow with the package at hand on the executors. ``keep`` names what the step keeps from task to task."""
    ship(df.sparkSession)

    def run(batches):
        give_up(keep)
        yield from step(batches)
        trim()

    return df.mapInArrow(run, schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only a local session may go without one."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir()
    if not found:
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf and not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(conf or tempfile.mkdtemp(prefix="cohortmark-"))
        found = sc.getCheckpointDir()
    return found


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Paths of the tables that each open ``passing`` block of this thread has written.
_passing: ContextVar[tuple[list[str], ...]] = ContextVar("passing", default=())


@contextmanager
def passing(spark: SparkSession):
    """Tables that ``stored`` and ``cut`` write inside the block are deleted at its end. What must outlive it is written by the function
    that the block gets."""

    def keep(df: DataFrame, name: str) -> DataFrame:
        return stored(df, name, outer=1)

    written: list[str] = []
    before = _passing.get()
    _passing.set((*before, written))
    try:
        yield keep
    finally:
        _passing.set(before)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in written:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
        gc.collect()  # plans that are no longer held free their shuffle files once the driver's JVM has collected them
        jvm.System.gc()


def stored(df: DataFrame, name: str, outer: int = 0) -> DataFrame:
    """Write as Parquet in the shared folder and read it again (column pruning stays possible)."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    open_blocks = _passing.get()
    if len(open_blocks) > outer:
        open_blocks[-1 - outer].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder, so that lost executors cost no recomputation from the start."""
    return stored(df, "cut")


def join_skewed(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key`` with a second, derived key, so that both sides get an exchange of their own.

    An aggregated side would otherwise keep the exchange of its aggregation, and Spark splits a hot
    partition only where both inputs of the join were dealt out for the join.
    """
    extra = F.xxhash64(F.col(key), F.lit(7))
    return left.withColumn("__k2", extra).join(right.withColumn("__k2", extra), [key, "__k2"], how).drop("__k2")


def small_enough(df: DataFrame, limit: int) -> bool:
    """True if ``df`` has at most ``limit`` rows: counts no further than that."""
    return df.limit(limit + 1).count() <= limit


def ranked(rows: DataFrame, *order: F.Column, **sums: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0) in the given order and, for each name=column, the column's sum over the rows before. No task sees all rows."""
    rows = stored(rows.orderBy(*order).withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), "ranked")
    totals = {"rank": F.count("*"), **{n: F.sum(c) for n, c in sums.items()}}
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    parts = rows.groupBy("__part").agg(*[v.alias(f"__{n}") for n, v in totals.items()])
    parts = parts.select("__part", *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__{n}") for n in totals])
    inside = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    own = {"rank": F.count("*").over(inside), **{n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()}}
    rows = rows.withColumns({f"__own_{n}": v for n, v in own.items()}).join(F.broadcast(parts), "__part")
    return rows.withColumns({n: F.col(f"__own_{n}") + F.col(f"__{n}") for n in totals}).drop("__part", "__at", *[f"__{n}" for n in totals], *[f"__own_{n}" for n in totals])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, in any case of letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(columns: list[str]) -> list[F.Column]:
    """Columns by names that may hold dots or quotes."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def by_ids(table: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``table`` whose key is in ``ids``: a broadcast of a counted size, else a shuffled join."""
    if small_enough(ids, BROADCAST_IDS):
        ids = F.broadcast(ids)
    return table.join(ids, key, "left_semi")


def text_steps(column: pa.Array, step: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of successive runs of rows of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + step, "right")) - 1)
        j = min(j, n)
        yield i, j, raw[off[i] : off[j]], (off[i : j + 1] - off[i]).astype(np.int64)
        i = j
