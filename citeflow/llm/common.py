"""What the corpus operators share: reading tables, the shared folder, lineage cuts, the memory of Python workers."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _base_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session, whose driver and executors share a disk, gets one of its own."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="citeflow-")
        context.setCheckpointDir(base)
    return base


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table in the folder that driver and executors share.

    A result that is read lazily needs its tables as long as it lives, so they stay, like checkpoints that are not
    cleaned; whoever owns the folder clears it.
    """
    return f"{_base_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that a lost executor costs no recomputation."""
    _base_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder; unlike a checkpoint it hands no constraints on, which add up in loops."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_bucket(id_column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus


def unused(taken: list[str], *names: str) -> dict[str, str]:
    """For each name one of its own kind that is not among ``taken``."""
    low, out = {c.lower() for c in taken}, {}
    for name in names:
        free = f"__{name}"
        while free in low:
            free += "_"
        out[name] = free
    return out


def slices(batches: Iterable, rows: int = 1024) -> Iterator:
    """Arrow batches cut into views of at most ``rows`` rows, so that what Python makes of one stays small."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def texts(batch_column) -> list:
    """The UTF-8 bytes of an Arrow string column, with b"" for null."""
    import pyarrow as pa

    column = batch_column.cast(pa.large_binary() if pa.types.is_large_string(batch_column.type) else pa.binary())
    return [x if x is not None else b"" for x in column.to_pylist()]


#: What this worker process keeps from one task to the next: one object at most.
_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """``make()``, once in a worker process, until a task that is ``frugal`` under another name begins."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def give_back() -> None:
    """What this process has freed goes back to the system: an executor answers for its idle workers' memory too."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux") and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def frugal(kernel: Callable[[Iterator], Iterator], name: str = "") -> Callable[[Iterator], Iterator]:
    """``kernel``, before which goes what the worker has kept under other names, and after which it gives memory back."""

    def run(batches: Iterator) -> Iterator:
        if name not in _KEPT:
            _KEPT.clear()
        try:
            yield from kernel(batches)
        finally:
            give_back()

    return run
