"""The shared folder for checkpoints and written tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster the
    executors could not reach it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


# The folders of the innermost open ``written_tables`` of this thread.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written_tables", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    written = _WRITTEN.get()
    if written is not None:
        written.append(folder)
    return folder


@contextlib.contextmanager
def written_tables(spark: SparkSession) -> Iterator[None]:
    """Remove at the end, also after an error, the folders that operators wrote for themselves inside.

    A result that reads them must be collected or stored elsewhere before. Scopes nest; each removes
    its own folders. Folders made by other threads inside, as by a running stream, stay.
    """
    folders: list[str] = []
    token = _WRITTEN.set(folders)
    try:
        yield
    finally:
        _WRITTEN.reset(token)
        for folder in folders:
            remove_folder(spark, folder)


# With this setting, Spark removes the shuffle files of a query when it ends, instead of some time after a
# garbage collection of the driver.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextlib.contextmanager
def settings(spark: SparkSession, changed: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold inside."""
    before = {key: spark.conf.get(key, None) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to and read from the shared folder.

    They are computed once, survive lost executors, and no longer follow changes of their sources.
    """
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    path, files = _file_system(spark, folder)
    return [str(f.getPath()) for f in files.listStatus(path) if f.isDirectory()] if files.exists(path) else []


def remove_folder(spark: SparkSession, folder: str) -> None:
    path, files = _file_system(spark, folder)
    files.delete(path, True)


def files_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder; none if there is no such folder."""
    path, files = _file_system(spark, folder)
    listed = files.listStatus(path) if files.exists(path) else []
    return [f.getPath().getName() for f in listed if f.isFile()]


def is_file(spark: SparkSession, name: str) -> bool:
    path, files = _file_system(spark, name)
    return files.exists(path) and files.getFileStatus(path).isFile()


def create_file(spark: SparkSession, name: str, text: str) -> bool:
    """Create a small file; false if it is there already."""
    path, files = _file_system(spark, name)
    files.mkdirs(path.getParent())
    if not files.createNewFile(path):
        return False
    if text:
        with_text = files.create(path, True)
        with_text.write(bytearray(text.encode()))
        with_text.close()
    return True


def write_file(spark: SparkSession, name: str, text: str) -> None:
    """Write a small file that is there as a whole or not at all."""
    path, files = _file_system(spark, name)
    draft, _ = _file_system(spark, f"{path.getParent().getParent()}/_{uuid.uuid4().hex}")
    files.mkdirs(path.getParent())
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(draft, path):
        raise FileExistsError(name)


def read_text(spark: SparkSession, name: str) -> str:
    path, files = _file_system(spark, name)
    opened = files.open(path)
    data = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(opened)
    opened.close()
    return bytes(data).decode()
