"""Paths on the file system the session is configured for: completeness markers, small records and listings."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def complete(spark: SparkSession, path: str) -> bool:
    """Was ``path`` written by a job that ended (its ``_SUCCESS`` marker stands)?"""
    at, fs = _fs(spark, f"{path.rstrip('/')}/_SUCCESS")
    return fs.exists(at)


def put(spark: SparkSession, path: str, record: dict) -> None:
    """Write a small record as JSON; it is there whole or not at all."""
    at, fs = _fs(spark, path)
    half, _ = _fs(spark, f"{path}.half")
    out = fs.create(half, True)
    try:
        out.write(bytearray(json.dumps(record, default=str).encode()))
    finally:
        out.close()
    fs.delete(at, False)
    if not fs.rename(half, at):
        raise OSError(f"cannot write {path}")


def get(spark: SparkSession, path: str) -> dict | None:
    """The record that ``put`` wrote; None where there is none."""
    at, fs = _fs(spark, path)
    if not fs.exists(at):
        return None
    held = fs.open(at)
    try:
        return json.loads(bytes(held.readAllBytes()).decode())
    finally:
        held.close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; none where there is no such folder."""
    at, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """``(name, bytes, modified)`` of every data file under ``path``, sorted; names are relative to it."""
    at, fs = _fs(spark, path)
    if not fs.exists(at):
        return []
    top = fs.getFileStatus(at)
    if top.isFile():
        return [(at.getName(), top.getLen(), top.getModificationTime())]
    root, out = top.getPath().toString(), []
    files = fs.listFiles(at, True)
    while files.hasNext():
        f = files.next()
        name = f.getPath().toString()[len(root) + 1:]
        if not any(p.startswith(("_", ".")) and "=" not in p for p in name.split("/")):
            out.append((name, f.getLen(), f.getModificationTime()))
    return sorted(out)


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _fs(spark, path)
    fs.delete(at, True)
