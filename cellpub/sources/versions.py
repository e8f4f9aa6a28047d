"""Tables with versions: what is written becomes current by one small file, so readers always find a whole table and two writers can't lose each other's.

    <root>/_versions/<number>   JSON: what is current since that version; the largest number counts
    <root>/<folder>/...         data, written before its version and never changed

A version is made only if nobody else has made it: in a store with atomic renames, a file is renamed to its number, which fails where that is taken; in a local folder it is linked.
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession


class Conflict(Exception):
    """Another writer has made this version."""


def _path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _path(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _path(spark, path)
    fs.delete(where, True)


def _names(spark: SparkSession, root: str) -> list[str]:
    fs, where = _path(spark, f"{root}/_versions")
    return sorted(name for s in fs.listStatus(where) if (name := s.getPath().getName()).isdigit()) if fs.exists(where) else []


def _read(spark: SparkSession, root: str, name: str) -> dict:
    fs, where = _path(spark, f"{root}/_versions/{name}")
    stream = fs.open(where)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()


def current(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the current version; (0, {}) without any."""
    names = _names(spark, root)
    return (int(names[-1]), _read(spark, root, names[-1])) if names else (0, {})


def commit(spark: SparkSession, root: str, seen: int, content: dict) -> int:
    """Make ``content`` the version after ``seen``, or raise ``Conflict`` if that one is there already."""
    number = seen + 1
    fs, place = _path(spark, f"{root}/_versions/{number:012d}")
    _, draft = _path(spark, f"{root}/_versions/draft-{uuid.uuid4().hex}")
    fs.mkdirs(place.getParent())
    stream = fs.create(draft, False)
    stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    stream.close()
    try:
        if fs.getScheme() == "file":
            os.link(draft.toUri().getPath(), place.toUri().getPath())  # a local rename would replace another's version
        elif not fs.rename(draft, place):
            raise FileExistsError
    except FileExistsError as e:
        raise Conflict(f"{root}: version {number} was made by another writer") from e
    finally:
        fs.delete(draft, False)
    return number


def forget(spark: SparkSession, root: str, folders: callable, keep: int = 2) -> None:
    """Delete data that only versions before the last ``keep`` name, and these versions: readers of the one before the current finish undisturbed. ``folders`` lists those of a content."""
    names = _names(spark, root)
    live = {f for name in names[-keep:] for f in folders(_read(spark, root, name))}
    for name in names[:-keep]:
        for folder in set(folders(_read(spark, root, name))) - live:
            delete(spark, f"{root}/{folder}")
        delete(spark, f"{root}/_versions/{name}")


def replace(df: DataFrame, root: str, check: callable = None, **options: str) -> int:
    """Write ``df`` as the next version of a table and return its number. ``check`` is called when the data is written, before it becomes current; an error there leaves the table as it was."""
    spark = df.sparkSession
    seen, _ = current(spark, root)
    folder = f"data-{uuid.uuid4().hex}"
    try:
        df.write.options(**options).parquet(f"{root}/{folder}")
        if check is not None:
            check()
        number = commit(spark, root, seen, {"folder": folder})
    except BaseException:
        delete(spark, f"{root}/{folder}")
        raise
    forget(spark, root, lambda c: [c["folder"]])
    return number


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The current version of a table."""
    number, content = current(spark, root)
    if not number:
        raise FileNotFoundError(f"{root} has no version")
    return spark.read.parquet(f"{root}/{content['folder']}")
