"""Shared pieces of the training-data operators: reading, Arrow batches, reliable checkpoints."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

#: What JVM `\s` without flags covers, and `bytes.split()` too: the white space of every word count here.
WORD = r"[^\x20\x09-\x0D]+"

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table of that name; only Spark's reader touches the path, so any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release() -> None:
    """Hands what a finished task has freed back to the system: workers live on between tasks, and what they hoard counts against the executor."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def map_batches(df: DataFrame, out: pa.Schema, start: Callable[[], Callable[[pa.RecordBatch], list]], slice_bytes: int = 4 << 20) -> DataFrame:
    """mapInArrow with one `start()` a task; what it returns turns a record batch into columns for `out`.

    Batches are cut by bytes as well as rows, and handed on in slices of about slice_bytes, so that neither
    many nor very long texts swell a Python worker.
    """
    conf = df.sparkSession.conf
    if BATCH_BYTES not in conf.getAll:  # a value that the session has set stays
        conf.set(BATCH_BYTES, str(16 << 20))

    def run(batches):
        f = start()
        try:
            for whole in batches:
                rows = max(1, whole.num_rows * slice_bytes // max(1, whole.nbytes))
                for at in range(0, whole.num_rows, rows):
                    columns = f(whole.slice(at, rows))
                    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=t.type) for c, t in zip(columns, out, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=out)
        finally:
            del f
            release()

    return df.mapInArrow(run, from_arrow_schema(out))


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut: written to the folder that the cluster names in spark.checkpoint.dir."""
    _set_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _set_checkpoint_dir(spark: SparkSession) -> None:
    """The session's setting is taken; a folder of our own is set only on one machine, as in tests."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="presslake-"))


def join_on(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Equi-join in which null equals null; the keys are kept once, from the left."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    return left.join(right, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys], how).drop(*[f"_right_{k}" for k in keys])


def nested(docs: DataFrame, name: str = "row") -> DataFrame:
    """docs as one column, so that no helper column beside it can clash with theirs."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(name))


class Scratch:
    """Tables written to the shared checkpoint folder, in place of lineage. clear() removes them; what a result
    still reads goes when the driver ends."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        sc = spark.sparkContext
        _set_checkpoint_dir(spark)
        self.root = f"{sc._jsc.sc().getCheckpointDir().get()}/presslake-{uuid.uuid4().hex}"
        self.n = 0

    def store(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.n}"
        self.n += 1
        df.write.parquet(path)
        if self.n == 1:
            root = self._path()
            root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(root)
        return self.spark.read.schema(df.schema).parquet(path)

    def _path(self):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.root)

    def clear(self) -> None:
        path = self._path()
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
