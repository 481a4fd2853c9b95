"""Files by path from Python, on the driver's planner and in tasks."""

from __future__ import annotations

import re

import pyarrow.fs as pafs


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """pyarrow's file system of ``path`` (local, hdfs, s3, gs, abfs) and the path in it."""
    if re.match(r"file:/", path):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))
    return pafs.LocalFileSystem(), path
