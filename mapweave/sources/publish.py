"""Publishing a folder as a whole.

Everything is written into a new folder beside the target; only when all of it
is complete does it take the target's place.  A job that fails leaves the old
data as they were, and readers never see a mixture.  The rename itself is as
atomic as the file system's.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def published(spark: SparkSession, path: str, overwrite: bool) -> Iterator[str]:
    """Yields the folder to write into and publishes it as ``path``."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target) and not overwrite:
        raise FileExistsError(f"{path} exists already")
    mark = uuid.uuid4().hex
    beside = lambda name: jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{name}-{mark}")
    new, old = beside("new"), beside("old")
    try:
        yield new.toString()
        # checked again: another writer may have come first
        if fs.exists(target):
            if not overwrite:
                raise FileExistsError(f"{path} exists already")
            _move(fs, target, old)
        try:
            _move(fs, new, target)
        except OSError:
            if fs.exists(old):
                fs.rename(old, target)
            raise
        fs.delete(old, True)
    finally:
        fs.delete(new, True)


def _move(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"Cannot rename {source.toString()} to {target.toString()}")
