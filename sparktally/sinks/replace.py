"""Replacing a folder of files as a whole.

``mode("overwrite")`` deletes the old output before the new one is written, so
a job that fails half-way leaves nothing. Here the new files are written to a
folder beside the target first; only when the write is complete are the two
exchanged by renames, and an old target is put back if that fails. A write may
also read the target that it replaces.

On file systems whose rename is not atomic (object stores) a reader may find
no target for the time of the exchange; it never finds half of one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to write to, which takes the place of ``path`` when the block
    ends; if it ends in an error, ``path`` stays as it was."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    run = uuid.uuid4().hex
    # Names that begin with an underscore are no data to Spark's readers.
    staging, old = (
        spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}.{what}-{run}") for what in ("new", "old")
    )
    try:
        yield staging.toString()
        had = fs.exists(target)
        if had and not fs.rename(target, old):
            raise OSError(f"could not set {path} aside")
        if not fs.rename(staging, target):
            if had:
                fs.rename(old, target)
            raise OSError(f"could not move the new files to {path}")
        if had:
            fs.delete(old, True)
    finally:
        fs.delete(staging, True)
