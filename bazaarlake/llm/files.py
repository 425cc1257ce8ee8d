"""Files that tasks write to and read from the cluster's shared storage."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from bazaarlake.session import scratch_path


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` as a full URI."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, label))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    return files.makeQualified(path).toString()


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; Hadoop writes local ones as ``file:/x``."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, stem: str, suffix: str) -> str:
    """A name no other attempt of the task uses."""
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


def write_file(uri: str, parts) -> int:
    """Writes the parts one after the other; returns the bytes written."""
    files, path = resolve(uri)
    if isinstance(files, fs.LocalFileSystem):
        os.makedirs(os.path.dirname(path), exist_ok=True)
    size = 0
    with files.open_output_stream(path, compression=None) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    return size


def open_file(uri: str):
    """For reads at any position."""
    files, path = resolve(uri)
    return files.open_input_file(path)
