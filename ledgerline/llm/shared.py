"""Small helpers the operators share: written intermediate tables, size-checked
broadcasts and SQL expression idioms."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import time
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.settings import checkpoint_dir

#: A word is a maximal run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"

#: Rows of two short columns that a broadcast may hold (about 32 MB); beyond it the join shuffles.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, name: str, free: bool = False, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return a reader of it.
    ``by``: a column that folders are made for, so a filter on it reads only its own.

    Cuts the lineage with files every executor can read, so a lost executor costs
    no recomputation; unlike ``checkpoint()`` the columns can be read singly.

    ``free``: the shuffles behind ``df`` were large and are not needed again. Spark
    deletes shuffle files when the driver's garbage collector meets their plans, which a
    driver with little to do puts off, so it is asked to run, once more after the
    listeners have let go of the finished query.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/ledgerline-llm/{name}-{uuid.uuid4().hex[:12]}"
    schema = df.schema
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    if free:
        del df
        for _ in range(2):
            time.sleep(1)
            gc.collect()
            spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(schema).parquet(path)
    out.settled_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete settled tables that no later step reads (other frames are left alone)."""
    for df in tables:
        path = getattr(df, "settled_at", None)
        if path:
            p = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are within ``limit``; else
    the join stays a shuffled one, which returns the same rows."""
    return F.broadcast(df) if rows <= limit else df


def kept(key: tuple, make: Callable[[], object]) -> object:
    """``make()``, kept in the Python worker for its next tasks; ``key`` must name the content. A worker
    keeps one value: another key, or ``release``, lets go of the one before."""
    state = sys.modules.setdefault("_ledgerline_kept", types.ModuleType("_ledgerline_kept")).__dict__
    if state.get("key") != key:
        release()
        state["value"] = make()
        state["key"] = key
    return state["value"]


def release() -> None:
    """Let go of what earlier tasks of this Python worker kept (for tasks that need the memory themselves)."""
    if "_ledgerline_kept" in sys.modules:
        sys.modules["_ledgerline_kept"].__dict__.update(key=None, value=None)


def handing_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The map function ``run``, whose Python worker hands freed memory back to the system after each task. The C library
    otherwise holds it in idle workers, beside the heap that later stages of the executor fill."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None  # glibc has it
            if trim is not None:
                trim(0)

    return task


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where ``body`` uses
    it inside a lambda (a plain reference would be inlined there and evaluated per element)."""
    return F.transform(F.array(value), body)[0]


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have (compared without case), one for each of ``names``."""
    taken = {c.lower() for c in df.columns}
    tail = "_"
    while any(n + tail in t for n in names for t in taken):
        tail += "_"
    return [n + tail for n in names]


def n_words(text: str | Column = "text") -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def has_nonspace(text: Column) -> Column:
    return text.rlike(r"[^\x20\x09-\x0D]")
