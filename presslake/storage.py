"""Tables on any store that Spark reaches: whole-table publish by swap, partial publish, appends, checkpoints."""

from __future__ import annotations

import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut in the shared folder that the session names in spark.checkpoint.dir; one of our own only on one machine."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="presslake-"))
    return df.checkpoint(eager=True)


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, with every column of schema; columns it doesn't have yet are NULL (tables grow by appending columns)."""
    wanted = spark.createDataFrame([], schema)
    if not _fs(spark, path)[0].exists(_fs(spark, path)[1]):
        return wanted
    return wanted.unionByName(spark.read.parquet(path), allowMissingColumns=True).select(*wanted.columns)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


POINTER = "_current"


def published_path(spark: SparkSession, path: str) -> str | None:
    """Where the table's present version lies; NULL before the first."""
    fs, pointer = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return f"{path}/{bytes(stream.readAllBytes()).decode()}"
    finally:
        stream.close()


def publish(df: DataFrame, path: str, keep: int = 2) -> None:
    """The table becomes df: written as a version of its own, then named by one small file, so a reader sees the old rows or the new
    ones on any store, object stores too. The newest `keep` versions stay for readers that are under way."""
    spark = df.sparkSession
    version = f"v{time.time_ns():020d}"
    df.write.parquet(f"{path}/{version}")
    fs, pointer = _fs(spark, f"{path}/{POINTER}")
    out = fs.create(pointer, True)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    versions = sorted(s.getPath().getName() for s in fs.listStatus(_fs(spark, path)[1]) if s.getPath().getName().startswith("v"))
    for old in versions[: -max(1, keep)]:
        fs.delete(_fs(spark, f"{path}/{old}")[1], True)


def published(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The published table; no rows before the first version."""
    return read(spark, published_path(spark, path) or f"{path}/none", schema)


def safe_identifier(name: str) -> str:
    """name, if it may stand in SQL as it is: letters, digits and underscores."""
    if not name.replace("_", "").isalnum():
        raise ValueError(f"unsafe schema identifier: {name!r}")
    return name


def upsert(stored: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """new replaces stored rows of equal keys, whole rows at a time; doing it twice changes nothing."""
    return stored.join(new.select(*keys), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def prune(stored: DataFrame, keep: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are kept; an empty keep-set leaves none."""
    return stored.join(keep.select(*keys), list(keys), "left_semi")


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Appends rows whose key isn't there yet (one of each), as a resumable writer does."""
    fs, p = _fs(df.sparkSession, path)
    rows = df.dropDuplicates([key])
    if fs.exists(p):
        rows = rows.join(df.sparkSession.read.parquet(path).select(key), key, "left_anti")
    rows.write.mode("append").parquet(path)


def export_json(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)
