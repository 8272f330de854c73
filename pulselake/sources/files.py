"""Files and folders of any store that Spark can reach: listing, small marker files, manifests.

Everything here handles names and small metadata, never rows.
"""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

MANIFEST = "_manifest"


class Conflict(RuntimeError):
    """Someone else has written the same version first."""


def _located(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the file system Spark uses for ``path``."""
    system, location = _located(spark, path)
    return system.exists(location)


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """All paths that match a pattern with ``*``, sorted."""
    system, location = _located(spark, pattern)
    return sorted(status.getPath().toString() for status in system.globStatus(location) or ())


def remove(spark: SparkSession, path: str) -> None:
    system, location = _located(spark, path)
    system.delete(location, True)


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file that must not exist yet."""
    system, location = _located(spark, path)
    try:
        out = system.create(location, False)
    except Exception as error:
        if isinstance(error, PySparkException) or not system.exists(location):
            raise
        raise Conflict(path) from error
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def partition_values(path: str, columns: tuple[str, ...]) -> tuple[str | None, ...]:
    """Values of the last folders ``column=value`` of a path; the default partition is null."""
    values = dict(part.split("=", 1) for part in path.rstrip("/").split("/")[-len(columns):])
    return tuple(None if values[c] == "__HIVE_DEFAULT_PARTITION__" else unquote(values[c]) for c in columns)


def latest_manifest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the newest manifest under ``root``; 0 and nothing before the first."""
    names = listed(spark, f"{root}/{MANIFEST}/v*.json")
    if not names:
        return 0, {}
    return int(names[-1].rsplit("/v", 1)[1].removesuffix(".json")), json.loads(read_text(spark, names[-1]))


def commit_manifest(spark: SparkSession, root: str, version: int, content: dict) -> None:
    """Publish a version in one step; fails with ``Conflict`` if it was published meanwhile."""
    create_once(spark, f"{root}/{MANIFEST}/v{version:012d}.json", json.dumps(content))
