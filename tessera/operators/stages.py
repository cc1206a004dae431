"""Cutting long plans: a table is written to the folder that driver and executors share, read again, and deleted when nothing reads it any more."""

from __future__ import annotations

import atexit
import contextvars
import itertools
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SERIAL = itertools.count()
_OWN_DIRS: dict[str, str] = {}
_WRITTEN: dict[str, SparkSession] = {}
_PATHS = "_tessera_paths"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
#: Paths handed out in the innermost settled() or recorded() of this thread.
_SCOPE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scope", default=None)
#: Writes under way in each session, and the setting before the first of them.
_WRITING: dict[int, tuple[int, str | None]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only a master of one machine may leave that unset; a folder of the driver's own is made then.
    """
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if given:
        return given.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="tessera-")
    return _OWN_DIRS[app]


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A path below shared_dir that nothing has used; it is removed by release(), or when the driver ends."""
    path = f"{shared_dir(spark)}/tessera/{tag}-{next(_SERIAL)}-{uuid.uuid4().hex[:12]}"
    _WRITTEN[path] = spark
    if (scope := _SCOPE.get()) is not None:
        scope.append(path)
    return path


@contextmanager
def _shuffles_read_once(spark: SparkSession) -> Iterator[None]:
    """Lets Spark delete the shuffle files of the writes inside as soon as they end; writes of several threads hold the setting together."""
    key = id(spark)
    with _LOCK:
        n, before = _WRITING.get(key, (0, None))
        if n == 0:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _WRITING[key] = (n + 1, before)
    try:
        yield
    finally:
        with _LOCK:
            n, before = _WRITING.pop(key)
            if n > 1:
                _WRITING[key] = (n - 1, before)
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, tag: str = "stage") -> DataFrame:
    """df, written as Parquet to the shared folder and read again.

    The plan above reads files instead of computing df again, and a lost
    executor costs no more than a second read. The write is the only use of its
    shuffles, so Spark may delete their files as soon as it has ended.
    """
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    with _shuffles_read_once(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    setattr(out, _PATHS, path)
    return out


written = materialize


def release(*tables: DataFrame | None) -> None:
    """Delete the files of tables that materialize() gave and that no plan will read again."""
    for table in tables:
        path = getattr(table, _PATHS, None)
        if path in _WRITTEN:
            remove(_WRITTEN.pop(path), path)


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """A list whose tables are released at the end of the block."""
    held: list[DataFrame] = []
    try:
        yield held
    finally:
        release(*held)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """A list of the paths that this thread hands out in the block; at its end, of those not yet released."""
    outer, made = _SCOPE.get(), []
    token = _SCOPE.set(made)
    try:
        yield made
    finally:
        _SCOPE.reset(token)
        made[:] = [p for p in made if p in _WRITTEN]
        if outer is not None:
            outer += made


def settled(make: Callable[[], DataFrame], tag: str = "stage") -> DataFrame:
    """The table that make() plans, written; the tables that it has written on the way are deleted."""
    with recorded() as made:
        out = materialize(make(), tag)
        release_paths([p for p in made if p != getattr(out, _PATHS)])
    return out


def release_paths(paths: list[str]) -> None:
    """As release(), for paths."""
    for path in paths:
        if path in _WRITTEN:
            remove(_WRITTEN.pop(path), path)
    paths.clear()


def remove(spark: SparkSession, path: str) -> None:
    """Delete what is below path, through Hadoop's file system for its scheme."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    held = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target)
    return [f.getPath().getName() for f in held if f.isDirectory()]


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in the place of another by one rename: readers find the old text or the new."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    new, target = hadoop.Path(f"{path}.{uuid.uuid4().hex[:12]}"), hadoop.Path(path)
    out = target.getFileSystem(conf).create(new, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    overwrite = getattr(hadoop, "Options$Rename").OVERWRITE
    how = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    how[0] = overwrite
    hadoop.FileContext.getFileContext(new.toUri(), conf).rename(new, target, how)


@atexit.register
def _clean() -> None:
    for path, spark in _WRITTEN.items():
        try:
            if spark.sparkContext._jsc is not None:
                remove(spark, path)
        except Exception:  # the JVM may be gone at exit; the folder is then the cluster's to clear
            return
