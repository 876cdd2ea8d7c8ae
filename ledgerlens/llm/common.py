"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word class of the contracts: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Language-model style case folding: A-Z only.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Unset, a local one serves a local session; a
    cluster without it is an error, as its executors would not see each other's files."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='ledgerlens-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
        except Exception:  # noqa: BLE001 - the session is already gone; the folder belongs to it
            pass


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder, deleted at exit."""
    path = f"{shared_dir(spark)}/ledgerlens/{what}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


class Scratch:
    """A written table in the shared folder: cuts lineage, survives executors, and is dropped at exit or by drop()."""

    def __init__(self, df: DataFrame, what: str):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, what)
        df.write.option("compression", "zstd").parquet(self.path)
        self.schema = df.schema

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        _written.remove((self.spark, self.path))
        _delete(self.spark, self.path)


def cut(df: DataFrame, what: str) -> DataFrame:
    """df, written to the shared folder and read back."""
    return Scratch(df, what).read()


def fold(col):
    """Lower-case A-Z and leave every other character alone."""
    return F.translate(col, UPPER, LOWER)


def ascii_lower(text: str) -> str:
    return text.translate(_FOLD)


_FOLD = str.maketrans(UPPER, LOWER)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """Runs of equal keys of a sorted partition, each as one table; a run may span batches."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if held and keys[a] != current:
                yield current, pa.Table.from_batches(held).combine_chunks()
                held = []
            current = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield current, pa.Table.from_batches(held).combine_chunks()


def strings(texts: pa.Array) -> list[str | None]:
    """to_pylist() of texts at an eighth of its time, as no scalar is made for each."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def slices(batch: pa.RecordBatch, column: int, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `most` bytes of text in a column, a single longer text by itself."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.flatnonzero(np.diff(ends // most)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings for what is planned inside; put back after it."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of queries that are done: it does so once the driver's JVM has collected their
    plans, by itself every half hour only."""
    import gc

    gc.collect()  # Python's references to them
    shrink_executors(spark)  # first, as Spark's threads hold on to the last query
    spark.sparkContext._jvm.System.gc()
    trim_driver(spark)


def trim_driver(spark: SparkSession) -> bool:
    """trim() for the driver's JVM: what its compiler and buffers have freed goes back to the system. False where the JVM
    has no command for that (before Java 17.0.9, other systems than Linux)."""
    from py4j.protocol import Py4JError

    gateway = spark.sparkContext._gateway
    java, javax = gateway.jvm.java, gateway.jvm.javax

    def array(kind, *items):
        out = gateway.new_array(kind, len(items))
        for i, item in enumerate(items):
            out[i] = item
        return out

    try:
        named = java.lang.Class.forName
        kinds = array(java.lang.Class, *map(named, ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")))
        # by reflection on the interface, as Py4J doesn't see into the server's own class
        invoke = named("javax.management.MBeanServer").getMethod("invoke", kinds)
        command = javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        invoke.invoke(java.lang.management.ManagementFactory.getPlatformMBeanServer(), array(java.lang.Object, command, "systemTrimNativeHeap", array(java.lang.Object), array(java.lang.String)))
    except Py4JError:
        return False
    return True


def shrink_executors(spark: SparkSession) -> None:
    """Collect the executors' garbage, which also makes their heaps smaller: else each holds what its largest stage so far
    took beside the Python workers of the next one. A task for each core, so that no executor is left out while all wait."""
    spark.range(0, (n := spark.sparkContext.defaultParallelism), 1, n).select(F.expr("java_method('java.lang.System', 'gc')")).write.format("noop").mode("overwrite").save()


def trim() -> None:
    """Give freed memory back to the system: a worker that waits for its next task holds none of the last one's."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def unused(taken: list[str], name: str) -> str:
    """name, with as many more underscores as it takes to differ from all of taken."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def fetch(df: DataFrame, at_once: int = 8) -> Iterator:
    """Rows of a bounded result on the driver, a share of about 1 / at_once at a time."""
    yield from df.coalesce(at_once).toLocalIterator(prefetchPartitions=True)
