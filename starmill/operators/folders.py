"""Folders of stored tables: hidden notes in them, replacement without a gap, moves that may be repeated.

A file system can rename a folder in one step but not exchange two.  A new version is therefore
finished beside the table, marked as ready, and only then put in its place; whoever opens the
table next completes or undoes a switch that was interrupted.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession

NEW, OLD, READY = "__new", "__old", "_ready"


def opened(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = opened(spark, path)
    return files.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    files, at = opened(spark, path)
    files.delete(at, True)


def rename(spark: SparkSession, source: str, goal: str) -> None:
    files, at = opened(spark, source)
    _, to = opened(spark, goal)
    files.mkdirs(to.getParent())
    if not files.rename(at, to):
        raise OSError(f"cannot move {source} to {goal}")


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, hidden ones too; none if it does not exist."""
    files, at = opened(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def read_note(spark: SparkSession, folder: str, name: str) -> str | None:
    """The text of a small hidden file, or None."""
    files, at = opened(spark, f"{folder}/{name}")
    if not files.exists(at):
        return None
    source = files.open(at)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def write_note(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Write a small hidden file (``name`` begins with an underscore, which readers of tables pass over) in one step."""
    files, draft = opened(spark, f"{folder}/{name}.draft")
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    _, at = opened(spark, f"{folder}/{name}")
    files.delete(at, False)
    files.rename(draft, at)


def beside(path: str) -> str:
    """Where a new version of a table is written."""
    return f"{path.rstrip('/')}{NEW}"


def switch(spark: SparkSession, path: str) -> None:
    """Put the finished folder ``beside`` a table in its place."""
    path = path.rstrip("/")
    write_note(spark, beside(path), READY, "")
    remove(spark, f"{path}{OLD}")
    if exists(spark, path):
        rename(spark, path, f"{path}{OLD}")
    rename(spark, beside(path), path)
    remove(spark, f"{path}{OLD}")


def settle(spark: SparkSession, path: str) -> str:
    """Complete or undo an interrupted switch, so that the table is there, old or new; gives back the path."""
    path = path.rstrip("/")
    if not exists(spark, path):
        if exists(spark, f"{beside(path)}/{READY}"):
            rename(spark, beside(path), path)
            remove(spark, f"{path}{OLD}")
        elif exists(spark, f"{path}{OLD}"):
            rename(spark, f"{path}{OLD}", path)
    return path


def data_files(spark: SparkSession, folder: str) -> Iterator[tuple[str, int]]:
    """Data files below a folder, as paths relative to it, and their sizes, from one listing."""
    files, at = opened(spark, folder)
    if not files.exists(at):
        return
    base = files.makeQualified(at).toUri().getPath().rstrip("/")
    listing = files.listFiles(at, True)
    while listing.hasNext():
        found = listing.next()
        relative = found.getPath().toUri().getPath()[len(base) + 1:]
        if not any(part.startswith(("_", ".")) for part in relative.split("/")):
            yield relative, found.getLen()


def data_paths(spark: SparkSession, folder: str) -> Iterator[str]:
    """Data files below a folder, as paths relative to it."""
    return (path for path, _ in data_files(spark, folder))


def move_all(spark: SparkSession, source: str, goal: str, tag: str = "") -> int:
    """Move all data files below ``source`` to the same places below ``goal``, and delete ``source``.

    Spark's file names are unique, so nothing is overwritten, and an interrupted move is completed by another one.  With
    a ``tag`` the files' names begin with it.
    """
    files, _ = opened(spark, goal)
    path, places = spark._jvm.org.apache.hadoop.fs.Path, {}
    for relative in data_paths(spark, source):
        place, _, name = relative.rpartition("/")
        places.setdefault(place, []).append(name)
    for place, names in places.items():
        here, there = path(f"{source}/{place}" if place else source), path(f"{goal}/{place}" if place else goal)
        if place and not tag and not files.exists(there):  # a new partition moves as a whole
            files.mkdirs(there.getParent())
            if files.rename(here, there):
                continue
        files.mkdirs(there)
        for name in names:
            if not files.rename(path(here, name), path(there, f"{tag}{name}")):
                raise OSError(f"cannot move {name} from {here} to {there}")
    remove(spark, source)
    return sum(map(len, places.values()))
