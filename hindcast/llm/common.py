"""What several text operators share: durable cuts of the lineage, word hashes, graph components.

Columns an operator does not need are dropped on entry, so extra columns with
clashing names can't reach its internals.
"""

from __future__ import annotations

import ctypes
import tempfile
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of rows that a task hands to Python at once; Spark's own bounds are 10,000 rows and 64 MB, held by the executor and by its worker.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 20
#: Word hashes kept by one Python worker before its cache is emptied.
CACHE_WORDS = 300_000
#: Seconds between two collections of the driver's garbage at least: shuffle files and checkpoints stay until the plans that read them are collected.
COLLECT_S = 10
_collected = {"at": float("-inf")}


def durable(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there, so a lost executor costs no recomputation.

    The folder is the cluster's spark.checkpoint.dir; only where none is set
    (tests on one machine) a temporary one is used.  While it is computed, rows
    go to Python BATCH_BYTES at a time, unless the session says how many.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="spark-ckpt-")
        sc.setCheckpointDir(folder)
    give_back()  # what the driver's Python has freed
    give_back_jvm(spark)
    if spark.conf.get(BATCH, None) is not None:
        return df.checkpoint(eager=True)
    spark.conf.set(BATCH, str(BATCH_BYTES))
    try:
        return df.checkpoint(eager=True)
    finally:
        spark.conf.unset(BATCH)


def fold(doc_id_column: str = "doc_id"):
    """Remainder that decides whether a document is held out (2) or may be learnt from."""
    return F.crc32(F.col(doc_id_column).cast("string").cast("binary")) % 4


class _Digests(dict):
    """8-byte hashes of words, made when first asked for."""

    def __init__(self, seed: int) -> None:
        self.seed = seed

    def __missing__(self, word: bytes) -> bytes:
        h = self[word] = xxhash.xxh3_64_digest(word, self.seed)
        return h


class WordHashes:
    """64-bit hashes of byte words, cached per worker because words repeat."""

    def __init__(self, seed: int = 0) -> None:
        self.known = _Digests(seed)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        return np.frombuffer(b"".join(map(self.known.__getitem__, words)), dtype=np.uint64)


_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values: equal stays equal, order becomes random."""
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX
    return x ^ (x >> np.uint64(32))


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words, in order of place; shorter texts give their whole sequence as one run."""
    if len(hashes) == 0:
        return hashes
    if len(hashes) < n:
        n = len(hashes)
        out = np.full(1, np.uint64(n))
    else:
        out = np.full(len(hashes) - n + 1, np.uint64(n))
    last = len(hashes) - n + 1
    for k in range(n):
        out = mix(out * _ODD + hashes[k : k + last])
    return out


def give_back() -> None:
    """Returns freed memory of this worker to the system; else it keeps what its largest batch took, beside the next stages' workers."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def give_back_jvm(spark: SparkSession) -> None:
    """The same for the driver's JVM: its many short threads and its compiler leave freed memory scattered over as many heaps as malloc has.

    By the JVM's own management command, on glibc; a JVM without it is left alone.
    Every COLLECT_S its garbage is collected before, and with it the files on disk that only garbage reads.
    """
    jvm = spark._jvm
    if time.monotonic() - _collected["at"] >= COLLECT_S:
        jvm.System.gc()
        _collected["at"] = time.monotonic()
    given = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)  # no parameters: the last two stay null
    given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()  # of a class that py4j may not call by itself
    invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    try:
        invoke.invoke(server, given)
    except Py4JError:
        pass


def text_rows(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, which bounds what a task holds at once."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(id, component) for every id of the edges (a, b) that has another: the smallest id reachable.

    Alternating large-star and small-star steps, until each id that isn't the
    smallest has one edge, to the smallest: each round halves paths at least; no
    node's neighbours are ever gathered in one place, only their minimum is.
    """
    e = durable(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct()
    )

    def unsettled(e: DataFrame) -> bool:
        ends = e.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), F.lit(1)))
        return not ends.groupBy("id").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 or (up > 0 and down > 0)").isEmpty()

    while unsettled(e):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m0")).select("u", F.least("u", "m0").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = durable(small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
