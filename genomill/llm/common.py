"""Shared plumbing of the text and vector operators: tables, folds, shared storage."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

_OWN: dict[str, str] = {}
_DEFAULT: dict[str, str] = {}
#: Text bytes that one step of a Python worker handles at a time.
STEP_BYTES = 3 << 20
#: Rows of a step at most, so that 16 bits number them.
STEP_ROWS = 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def workspace(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.  Only where the
    session has none (local tests) a temporary folder is made, and removed at exit."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/genomill"
    if "dir" not in _OWN:
        _OWN["dir"] = tempfile.mkdtemp(prefix="genomill-")
        atexit.register(shutil.rmtree, _OWN["dir"], ignore_errors=True)
    return f"file://{_OWN['dir']}"


def save(df: DataFrame, label: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back, which cuts lineage and
    survives the loss of any executor."""
    path = f"{workspace(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(*frames: DataFrame, clean: bool = False) -> None:
    """Deletes tables made by ``save`` that nothing will read again; ``clean`` also sweeps."""
    for frame in frames:
        spark = frame.sparkSession
        for name in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            if workspace(spark).split("://")[-1] in name:
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    if frames and clean:
        sweep(frames[0].sparkSession)


def sweep(spark: SparkSession) -> None:
    """Has the driver look for shuffles that nothing refers to any more, whose files then go."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB, however long the texts are, unless the session has
    set a bound of its own."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == _DEFAULT.setdefault(key, spark.conf.get(key)):
        spark.conf.set(key, "8m")


def fold(doc_id: str | Column, mod: int) -> Column:
    """crc32 of the decimal doc_id, modulo ``mod``; null ids fall into no fold."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % F.lit(mod)


#: What a worker keeps between tasks, by owner, and how to let it go.
_HELD: dict[str, Callable[[], None]] = {}


def hold(owner: str, clear: Callable[[], None]) -> None:
    _HELD[owner] = clear


def only(owner: str = "") -> None:
    """Lets go of what other operators' tasks have left in this worker."""
    others = [k for k in _HELD if k != owner]
    for k in others:
        _HELD.pop(k)()
    if others:
        trim()


def trim() -> None:
    """Gives freed memory back to the system, so that idle workers stay small."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def keep_freed() -> None:
    """Has this worker's malloc keep up to 32 MB that arrays leave, which the next ones take,
    rather than give pages back after each step and fault them in again."""
    with contextlib.suppress(OSError, AttributeError):
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 8 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 32 << 20)  # M_TRIM_THRESHOLD


def steps(batches: Iterator[pa.RecordBatch], column: str, most: int = STEP_BYTES, owner: str = "") -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches whose text column has about ``most`` bytes (one row at least)."""
    only(owner)
    for batch in batches:
        col = batch.column(column)
        n = batch.num_rows
        if not n:
            continue
        size = np.zeros(n, np.int64)
        lens = pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False)
        size[:] = lens
        total = np.cumsum(size)
        i = 0
        while i < n:
            base = total[i - 1] if i else 0
            j = min(max(i + 1, int(np.searchsorted(total, base + most, side="right"))), i + STEP_ROWS)
            yield batch.slice(i, j - i)
            i = j
    trim()


def ragged(values: np.ndarray, lens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + lens[i]] of all i, one after another."""
    to = np.cumsum(lens)
    total = int(to[-1]) if len(to) else 0
    if not total:
        return values[:0]
    return values[np.repeat(starts - (to - lens), lens) + np.arange(total)]


#: Bits of the filter below: at most 2**17 words of 64 bits, whatever is put in.
FILTER_BITS = 1 << 23


def maybe_in(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``column`` may be among ``ids(id)``: a hashed bitmap of fixed size is
    broadcast, so that a join that follows shuffles few other rows.  Rows that are among the
    ids always stay; with very many ids the others stay too."""

    def spot(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(c).cast("bigint")), F.lit(FILTER_BITS))

    words = ids.select(spot("id").alias("h")).groupBy(F.shiftright("h", 6).cast("int").alias("_w"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("_m"))
    marked = rows.withColumn("_h", spot(column)).withColumn("_w", F.shiftright("_h", 6).cast("int"))
    return marked.join(F.broadcast(words), "_w").filter("(shiftright(_m, cast(_h & 63 as int)) & 1) = 1").drop("_h", "_w", "_m")


#: A key is hot that has more than this part of the rows, and of these at least so many.
HOT_PART, HOT_LEAST = 512, 1000


def hot_keys(counts: DataFrame, total: int) -> DataFrame:
    """The rows of ``counts(..., n)`` whose key is hot: fewer than HOT_PART for each way of
    splitting ``total`` rows by keys, whatever their number, so that they may be broadcast."""
    return counts.filter(F.col("n") > max(HOT_LEAST, total // HOT_PART))


def spread_join(many: DataFrame, one: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of ``many`` (of ``total`` rows) with ``one``, which is unique by ``key``: rows
    of hot keys meet a broadcast of the few rows that they need, and stay where they are."""
    hot = [r[key] for r in hot_keys(many.groupBy(key).agg(F.count(F.lit(1)).alias("n")), total).collect()]
    if not hot:
        return many.join(one, key)
    is_hot = F.col(key).isin(hot)
    return many.filter(is_hot).join(F.broadcast(one.filter(is_hot)), key).unionByName(many.filter(~is_hot).join(one.filter(~is_hot), key))
