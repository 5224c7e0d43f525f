"""A pointer to the folders that count: several tables become visible together, by one rename.

Below ``<root>/_versions`` lies one small file per version, its number as name and
a JSON object as content.  The highest number counts.  A version is written
under another name first and renamed when whole, so a reader never sees half of
one, and a job that fails before that leaves what was visible before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

FOLDER = "_versions"


def filesystem(spark: SparkSession, path: str):
    """The file system a path lies in, and the class of its paths."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions below ``root``, ascending; none when nothing was published."""
    fs, path = filesystem(spark, root)
    folder = path(f"{root}/{FOLDER}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def current(spark: SparkSession, root: str) -> dict | None:
    """Content of the version that counts, None when nothing was published."""
    found = numbers(spark, root)
    if not found:
        return None
    fs, path = filesystem(spark, root)
    stream = fs.open(path(f"{root}/{FOLDER}/{found[-1]}.json"))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def publish(spark: SparkSession, root: str, content: dict, after: int | None = None) -> int:
    """Make ``content`` the version that counts; returns its number.

    ``after`` is the number the job started from (0: nothing published yet): if
    another job has published since, this one fails and changes nothing.
    """
    found = numbers(spark, root)
    last = found[-1] if found else 0
    if after is not None and last != after:
        raise RuntimeError(f"version {last} of {root} was published since this job read version {after}")
    fs, path = filesystem(spark, root)
    staged, target = path(f"{root}/{FOLDER}/.{uuid.uuid4().hex}"), path(f"{root}/{FOLDER}/{last + 1}.json")
    stream = fs.create(staged, False)
    stream.write(bytearray(json.dumps(content, sort_keys=True).encode("utf-8")))
    stream.close()
    if fs.exists(target) or not fs.rename(staged, target):
        raise RuntimeError(f"version {last + 1} of {root} was published by another job")
    return last + 1


def run_published(spark: SparkSession, root: str, job: Callable[[str], dict[str, str]]) -> dict[str, str]:
    """Run ``job`` on a folder of its own below ``root`` and publish the paths it returns.

    Whatever stage it fails in, readers of ``current`` keep the paths of before.
    """
    found = numbers(spark, root)
    paths = job(f"{root}/job-{uuid.uuid4().hex}")
    publish(spark, root, paths, after=found[-1] if found else 0)
    return paths


def remove(spark: SparkSession, root: str, name: str) -> None:
    """Delete a folder below ``root`` that no version names any more."""
    if not name or name.startswith((".", "/")) or ".." in name or name == FOLDER:
        raise ValueError(f"not the name of a folder below {root}: {name!r}")
    fs, path = filesystem(spark, root)
    fs.delete(path(f"{root}/{name}"), True)
