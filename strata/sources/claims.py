"""Claims: which of several writers of one run goes on.

A claim is an empty marker file, made only if no file of that name exists
(``create`` without overwrite, which file systems carry out as one step). Its
holder puts the run's data into place and appends the record, then removes it;
the others wait until the run is recorded or the marker is gone. The marker of a
writer that died is outlived: when it is older than ``stale_after`` seconds by
the file system's clock, the next in number is made, by one writer again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from strata.session import hadoop_path

STALE_AFTER = 3600.0


def _create(spark: SparkSession, path: str) -> bool:
    """Make an empty file unless there is one; False when there is."""
    fs, p = hadoop_path(spark, path)
    jvm = spark.sparkContext._jvm
    fs.mkdirs(p.getParent())
    try:
        if fs.getUri().getScheme() == "file":
            # The local file system of Hadoop looks first and then creates; the
            # platform's own call does both at once.
            return bool(jvm.java.io.File(p.toUri().getPath()).createNewFile())
        fs.create(p, False).close()
        return True
    except Py4JJavaError as exc:
        if fs.exists(p):
            return False
        raise OSError(f"marker {path} could not be made") from exc


def _now(spark: SparkSession, folder: str) -> float:
    """The file system's clock in seconds: the time of a file made just now."""
    fs, p = hadoop_path(spark, f"{folder}/_clock-{uuid.uuid4().hex}")
    try:
        fs.create(p, False).close()
        return fs.getFileStatus(p).getModificationTime() / 1000
    finally:
        fs.delete(p, False)


def _markers(spark: SparkSession, folder: str) -> list[tuple[int, float]]:
    """(number, time made) of a run's markers, ascending."""
    fs, p = hadoop_path(spark, folder)
    if not fs.exists(p):
        return []
    names = [(s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(p)]
    return sorted((int(n), t) for n, t in names if n.isdigit())


def claim(spark: SparkSession, folder: str, stale_after: float = STALE_AFTER) -> str | None:
    """The marker this writer now holds, or None while another one's is valid."""
    held = _markers(spark, folder)
    if held and _now(spark, folder) - held[-1][1] <= stale_after:
        return None
    marker = f"{folder}/{held[-1][0] + 1 if held else 1}"
    return marker if _create(spark, marker) else None


def holds(spark: SparkSession, marker: str) -> bool:
    """Whether the marker is there and no later writer has outlived it."""
    folder, number = marker.rsplit("/", 1)
    held = _markers(spark, folder)
    return bool(held) and held[-1][0] == int(number)


def release(spark: SparkSession, marker: str) -> None:
    """Remove a claim and those it outlived."""
    folder, number = marker.rsplit("/", 1)
    fs, _ = hadoop_path(spark, folder)
    for n, _ in _markers(spark, folder):
        if n <= int(number):
            fs.delete(hadoop_path(spark, f"{folder}/{n}")[1], False)


def claim_unless(done: Callable[[], bool], spark: SparkSession, folder: str, stale_after: float = STALE_AFTER,
                 poll: float = 0.5) -> str | None:
    """Wait for the claim and return its marker, or None once ``done()`` holds.

    ``done`` is asked again under the claim: its last holder may have finished
    between the question and the claim."""
    while True:
        if done():
            return None
        marker = claim(spark, folder, stale_after)
        if marker is None:
            time.sleep(poll)
            continue
        if not done():
            return marker
        release(spark, marker)
        return None
