"""Scratch tables in the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import urllib.parse
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

from . import exclusive

HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of files that one share of a table comes from, and shares at most.
SHARE, MAX_SHARES = 32_000_000, 4

_own_dirs: dict[str, str] = {}
_staged: dict[str, list[str]] = {}
_passing: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("passing", default=None)


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset: a temporary folder in local mode, an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        found = _own_dirs.get(app) or _own_dirs.setdefault(app, "file://" + tempfile.mkdtemp(prefix="spark-"))
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Plans that run inside have no generated method that the JVM only interprets, as it does those of over 8,000 bytes: a stage
    with such a method (wide rows make one) runs by operators instead, whose code is cut in small ones."""
    was = spark.conf.get(HUGE_METHOD)
    spark.conf.set(HUGE_METHOD, str(min(int(was), 8000)))
    try:
        yield
    finally:
        spark.conf.set(HUGE_METHOD, was)


@contextlib.contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs inside go when it ends, not when the driver happens to collect its garbage. A frame that
    is run inside and once more after makes its shuffles again."""
    was = spark.conf.get(SHUFFLES_GO)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, was)


def write(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "error") -> None:
    """Parquet files of `df`, in folders by the columns `by`; they take less room than by Spark's default codec."""
    with compiled(df.sparkSession), tidied(df.sparkSession):
        df.write.mode(mode).partitionBy(*by).parquet(path, compression="zstd")


def shares(df: DataFrame) -> int:
    """In how many shares rows are best moved that `df` has from files, so that shuffles take the disk of one share at a time: more,
    up to `MAX_SHARES`, the more bytes there are to read, as each share reads them all."""
    folders = {urllib.parse.unquote(f).rsplit("/", 1)[0] for f in df.inputFiles()}
    return min(MAX_SHARES, 1 + sum(exclusive.size(df.sparkSession, f) for f in folders) // SHARE)


def staged(df: DataFrame | Sequence[DataFrame], name: str) -> DataFrame:
    """`df` written to the shared folder and read back: what reads it several times computes it once. Results that are not read
    yet may need it; `clear` deletes all of a session's. Several frames are shares of one table and written one after the other."""
    parts = [df] if isinstance(df, DataFrame) else df
    df = parts[0]
    path = scratch(df.sparkSession, name)
    _staged.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    if _passing.get() is not None:
        _passing.get().append(path)
    for part in parts:
        write(part, path, mode="error" if part is df else "append")
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that are staged inside, by this thread, are deleted at the end: for work whose results are written elsewhere."""
    mine: list[str] = []
    token = _passing.set(mine)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in mine:
            exclusive.delete(spark, path)
            _staged[spark.sparkContext.applicationId].remove(path)


def drop(df: DataFrame) -> None:
    """Deletes the tables that `staged` made and `df` reads, before their time: nothing that is still to be read needs them."""
    spark, files = df.sparkSession, df.inputFiles()
    mine = _staged.get(spark.sparkContext.applicationId, [])
    for path in [p for p in mine if any(p.rsplit("/", 1)[1] in f.split("/") for f in files)]:
        exclusive.delete(spark, path)
        for held in (mine, _passing.get() or []):
            if path in held:
                held.remove(path)


def clear(spark: SparkSession) -> int:
    """Deletes all tables that this session has staged so far; for use between runs, when no result of theirs is still to be
    read. Returns how many there were."""
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        exclusive.delete(spark, path)
    return len(paths)
