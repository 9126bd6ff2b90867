"""Artefacts that belong together, published as one version."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

MANIFEST = "manifest.json"


def publish(spark: SparkSession, path: str, parts: dict[str, Callable[[str], None]]) -> str:
    """Write all parts into a new version under ``path`` and return its folder.

    Each part is a function that writes to the folder it is given. The manifest is written last and appears whole, by a rename; a version
    without one does not exist for readers. So a reader never sees parts of two runs, and a run that
    fails in between leaves the version before it in use. Two runs at a time get versions of their own.
    """
    fs, root = _folder(spark, path)
    number = max((int(name.split("-")[0][1:]) for name in _versions(fs, root)), default=0) + 1
    version = f"{path.rstrip('/')}/v{number:08d}-{uuid.uuid4().hex[:8]}"
    for name, write in parts.items():
        write(f"{version}/{name}")
    hidden = _path(spark, f"{version}/_{MANIFEST}")
    out = fs.create(hidden, True)
    out.write(json.dumps({"parts": sorted(parts)}).encode())
    out.close()
    if not fs.rename(hidden, _path(spark, f"{version}/{MANIFEST}")):
        raise OSError(f"the manifest of {version} could not be put in place")
    return version


def newest_version(spark: SparkSession, path: str) -> str:
    """Folder of the newest complete version under ``path``."""
    fs, root = _folder(spark, path)
    for name in sorted(_versions(fs, root), reverse=True):
        if fs.exists(_path(spark, f"{path}/{name}/{MANIFEST}")):
            return f"{path.rstrip('/')}/{name}"
    raise FileNotFoundError(f"no complete version under {path}")


def retire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all versions older than the ``keep`` newest complete ones; gives their names. Readers of a kept one are not disturbed."""
    if keep < 1:
        raise ValueError("at least one version must be kept")
    fs, root = _folder(spark, path)
    names = sorted(_versions(fs, root), reverse=True)
    complete = [n for n in names if fs.exists(_path(spark, f"{path}/{n}/{MANIFEST}"))]
    if len(complete) < keep:
        return []
    old = [n for n in names if n < complete[keep - 1]]
    for name in old:
        fs.delete(_path(spark, f"{path}/{name}"), True)
    return old


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _folder(spark: SparkSession, path: str):
    root = _path(spark, path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def _versions(fs, root) -> list[str]:
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return [n for n in names if n[:1] == "v" and n[1:9].isdigit()]
