"""Where intermediate tables go and how they are removed, folders on any file system, and
how narrow inputs are widened."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_local_root: list[str] = []
_folders: list[str] = []
_databases: list[str] = []
#: one list for each ``passing`` block that is open; plain lists, since functions sent to tasks may take globals along
_passing: list[list[str]] = []


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the folder every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors are one machine, may fall back to a
    temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        if not _local_root:
            _local_root.append(tempfile.mkdtemp(prefix="fraclake-"))
        root = _local_root[0]
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _folders.append(path)
    if _passing:
        _passing[-1].append(path)
    return path


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[list[str]]:
    """Folders made inside are removed at the end, but for those taken out of the list."""
    made: list[str] = []
    _passing.append(made)
    try:
        yield made
    finally:
        _passing.remove(made)
        for folder in made:
            store, path = _hadoop(spark, folder)
            store.delete(path, True)
            _folders.remove(folder)


def fresh_database(spark: SparkSession) -> str:
    """A new database kept in a shared folder."""
    _databases.append(f"fraclake_{uuid.uuid4().hex}")
    spark.sql(f"CREATE DATABASE {_databases[-1]} LOCATION '{shared_folder(spark, 'warehouse')}'")
    return _databases[-1]


def clean_up(spark: SparkSession) -> None:
    """Drop the databases and remove the folders that this process has made so far.

    Results are lazy, so call it when they have been read or written elsewhere.
    """
    while _databases:
        spark.sql(f"DROP DATABASE IF EXISTS {_databases.pop()} CASCADE")
    while _folders:
        store, path = _hadoop(spark, _folders.pop())
        store.delete(path, True)


def _hadoop(spark: SparkSession, uri: str) -> tuple:
    """The file system of a path as Spark itself resolves it, and the path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, uri: str) -> bool:
    store, path = _hadoop(spark, uri)
    return store.exists(path)


def located(spark: SparkSession, uri: str) -> tuple[str, str]:
    """The full path of ``uri`` as tasks can open it, which is a plain one for local files, and its
    path within the store as a URI has it."""
    store, path = _hadoop(spark, uri)
    full = store.makeQualified(path)
    return full.toUri().getPath() if full.toUri().getScheme() == "file" else full.toString(), full.toUri().getRawPath()


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder its final name; an empty job leaves an empty folder."""
    store, path = _hadoop(spark, source)
    _, to = _hadoop(spark, target)
    if not (store.rename(path, to) if store.exists(path) else store.mkdirs(to)):
        raise OSError(f"{source} could not be renamed to {target}")


def delete(spark: SparkSession, uri: str) -> None:
    store, path = _hadoop(spark, uri)
    store.delete(path, True)


def claim(spark: SparkSession, uri: str, text: str) -> bool:
    """Create a file with this text; False if there is one already. Of several callers at once one succeeds.

    The text is written under another name first. On a local file system it then gets its
    name by a link, on HDFS by a rename, both of which fail where there is a file. Other
    stores publish a file whole when it is closed and are asked not to overwrite.
    """
    store, path = _hadoop(spark, uri)
    scheme = store.getUri().getScheme()
    store.mkdirs(path.getParent())
    if scheme not in ("file", "hdfs", "viewfs", "webhdfs"):
        try:
            _put(store, path, text)
        except Py4JJavaError as problem:
            if "FileAlreadyExists" not in problem.java_exception.getClass().getName():
                raise
            return False
        return True
    partial = path.suffix(f".{uuid.uuid4().hex}.part")
    _put(store, partial, text)
    try:
        if scheme != "file":
            return store.rename(partial, path)
        os.link(partial.toUri().getPath(), path.toUri().getPath())
        return True
    except FileExistsError:
        return False
    finally:
        store.delete(partial, False)


def _put(store, path, text: str) -> None:
    stream = store.create(path, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def entries(spark: SparkSession, uri: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    store, path = _hadoop(spark, uri)
    return sorted(s.getPath().getName() for s in store.listStatus(path)) if store.exists(path) else []


def small_text(spark: SparkSession, uri: str, limit: int = 1 << 24) -> str | None:
    """The text of one small file, whatever its name; None if there is none or it is no such text."""
    store, path = _hadoop(spark, uri)
    if not store.exists(path) or not 0 <= store.getFileStatus(path).getLen() <= limit:
        return None
    stream = store.open(path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    except UnicodeDecodeError:
        return None
    finally:
        stream.close()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, so that several consumers share one
    computation and a lost executor never has to redo it."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def widen(scan: DataFrame) -> DataFrame:
    """Spread a file scan evenly over all cores when it has fewer splits than cores.

    Large inputs already have far more splits than cores and are left alone, so
    the extra shuffle is only ever paid on small or single-file inputs; it deals rows
    in turn, so no key is heavy. Pass a plain scan: asking a plan with shuffles for its
    partitions would run them.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= 2 * cores:
        return scan
    return scan.repartition(2 * cores)
