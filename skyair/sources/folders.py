"""Publishing folders by renaming: a reader finds the old one or the new one, never half of either.

Through the file system the session is configured for. Where a store has no rename of its own (some object
stores copy instead), the swap is as safe, only slower.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _beside(path: str, ending: str) -> str:
    """A neighbour whose name Spark's readers pass over."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{ending}"


def staged_beside(path: str) -> str:
    """Where the next content of ``path`` is written: one place, so what a job that died left is overwritten."""
    return path.rstrip("/") + ".next"


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename; the target's parents are made, the target must not exist."""
    files, place = _at(spark, source)
    to = _at(spark, target)[1]
    files.mkdirs(to.getParent())
    if files.exists(to) or not files.rename(place, to):
        raise OSError(f"could not move {source} to {target}")


def recover(spark: SparkSession, path: str) -> None:
    """Bring back the old content of ``path`` if a job died between the two renames of ``publish``."""
    previous = _beside(path, "previous")
    if not exists(spark, path) and exists(spark, previous):
        move(spark, previous, path)


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put the finished folder ``staged`` in the place of ``path``.

    The old content is set aside until the new one is in place; ``recover`` restores it after a crash in
    between. One job publishes to a path at a time.
    """
    recover(spark, path)
    previous = _beside(path, "previous")
    if exists(spark, path):
        remove(spark, previous)
        move(spark, path, previous)
    move(spark, staged, path)
    remove(spark, previous)


def add_files(spark: SparkSession, source: str, target: str) -> None:
    """Move the files of one folder into another that may hold files already; can be repeated.

    Names of Spark's files are unique, so none is replaced.
    """
    if not exists(spark, source):
        return
    files, place = _at(spark, source)
    for found in files.listStatus(place):
        name = found.getPath().getName()
        if not name.startswith(("_", ".")):
            move(spark, f"{source}/{name}", f"{target}/{name}")
    remove(spark, source)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a glob pattern, in order of name."""
    files, place = _at(spark, pattern)
    return sorted(str(found.getPath().toString()) for found in files.globStatus(place) or ())
