"""Path helpers through the public DataFrame API.

Listings use the ``binaryFile`` source with its ``content`` column pruned, so
only file metadata (path, length) is read; they work on any Hadoop-compatible
store and under Spark Connect. Large folders are never probed here: input
tables and main versions are opened by reading them (one listing, reused)."""

from __future__ import annotations

import os
from functools import reduce
from urllib.parse import unquote, urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def missing(exc: AnalysisException) -> bool:
    return (exc.getCondition() or "") == "PATH_NOT_FOUND"


def listing(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame | None:
    """``(path, length)`` of the data files under ``path`` (hidden ``_``/``.``
    files excluded), or None if the path does not exist."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        return reader.load(path).select("path", "length")
    except AnalysisException as exc:
        if missing(exc):
            return None
        raise


def exists(spark: SparkSession, path: str) -> bool:
    """For small folders (audit tables, key sets, archived parts)."""
    return listing(spark, path) is not None


def try_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """``spark.read.parquet(path)``, or None if the path does not exist."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as exc:
        if missing(exc):
            return None
        raise


def files(spark: SparkSession, path: str, suffix: str = ".parquet") -> tuple[int, int]:
    """(number of data files, total bytes) under ``path``; (0, 0) if absent."""
    lst = listing(spark, path)
    if lst is None:
        return 0, 0
    row = lst.filter(F.col("path").endswith(suffix)).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def total_bytes(spark: SparkSession, paths: list[str]) -> dict[str, int]:
    """Bytes under each of ``paths`` (recursive): the listings are unioned, so
    one small aggregation job serves all of them."""
    found = [(p, lst) for p in paths if (lst := listing(spark, p, recursive=True)) is not None]
    out = {p: 0 for p in paths}
    if found:
        tagged = [lst.select(F.lit(p).alias("root"), "length") for p, lst in found]
        u = reduce(DataFrame.unionByName, tagged)
        for r in u.groupBy("root").agg(F.sum("length").alias("b")).collect():
            out[r["root"]] = int(r["b"] or 0)
    return out


def file_rows(spark: SparkSession, paths: list[str]) -> list:
    """(name, length, modified) of the files under ``paths``: the name as a scan's
    ``_metadata.file_path`` spells it, the time in milliseconds."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(paths).select(F.col("_metadata.file_path").alias("name"), "length",
                                     F.unix_millis("modificationTime").alias("modified")).collect()


def base_path(spark: SparkSession, root: str) -> str:
    """The path part of a root, without scheme and authority."""
    fsys, p = _hadoop(spark, root)
    return fsys.makeQualified(p).toUri().getPath().rstrip("/")


def below(base: str, name: str) -> str | None:
    """A file's path relative to a base path, or None if it is elsewhere."""
    path = unquote(urlsplit(name).path)
    return path[len(base) + 1:] if path.startswith(base + "/") else None


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` if it is absent; False if another one has it. The
    file system decides: its exclusive create (a shared mount: ``O_EXCL``)."""
    fsys, p = _hadoop(spark, path)
    fsys.mkdirs(p.getParent())
    p = fsys.makeQualified(p)
    if fsys.getScheme() == "file":
        try:
            fd = os.open(p.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            return False
        os.write(fd, text.encode())
        os.close(fd)
        return True
    try:
        out = fsys.create(p, False)
    except Exception as exc:  # of the gateway: its Java cause tells
        if fsys.exists(p):
            return False
        raise exc
    out.write(bytearray(text.encode()))
    out.close()
    return True


def present(spark: SparkSession, path: str) -> bool:
    fsys, p = _hadoop(spark, path)
    return bool(fsys.exists(p))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path`` (hidden ones excluded), by one non-recursive
    listing through the session's Hadoop FileSystem; [] if absent."""
    fsys, p = _hadoop(spark, path)
    if not fsys.exists(p):
        return []
    names = (s.getPath().getName() for s in fsys.listStatus(p))
    return sorted(n for n in names if not n.startswith(("_", ".")))


def join(*parts: str) -> str:
    head, *rest = parts
    return "/".join([head.rstrip("/"), *[r.strip("/") for r in rest]])


def _hadoop(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p
