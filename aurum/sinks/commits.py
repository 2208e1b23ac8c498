"""Committed versions: one small file per version names what belongs together.

Data is written to fresh folders that no reader looks at; a commit file then
makes them the current version at once. A reader that starts from the newest
commit sees the folders of one version only, whatever a writer is doing or
where one stopped. A version's number is taken by creating its file, which
fails if another writer was first; a commit that was cut off doesn't parse and
counts for nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from aurum.session import _file_system, child_names


class Conflict(RuntimeError):
    """Another writer committed the version first."""


def commit(spark: SparkSession, folder: str, version: int, content: dict) -> None:
    """Make ``content`` version ``version`` (the newest one plus one)."""
    path, fs = _file_system(spark, f"{folder.rstrip('/')}/{version:012d}.json")
    try:
        out = fs.create(path, False)
    except Exception as e:  # noqa: BLE001  (the file system's own exception)
        if fs.exists(path):
            raise Conflict(f"version {version} of {folder} is taken") from e
        raise
    try:
        out.write(bytearray((json.dumps(content) + "\n").encode()))
    finally:
        out.close()


def newest(spark: SparkSession, folder: str) -> tuple[int, dict | None]:
    """The highest version number taken and the content of the newest whole
    commit; ``-1, None`` before the first."""
    numbers = sorted((int(n[:-5]) for n in child_names(spark, folder) if n.endswith(".json") and n[:-5].isdigit()), reverse=True)
    for number in numbers:
        path, fs = _file_system(spark, f"{folder.rstrip('/')}/{number:012d}.json")
        stream = fs.open(path)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        if text.endswith("\n"):
            return numbers[0], json.loads(text)
    return (numbers[0] if numbers else -1), None
