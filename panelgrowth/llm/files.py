"""Files that tasks write into, and read from, the shared folder.

Paths are URIs of the folder named by ``spark.checkpoint.dir``, opened through
pyarrow's file systems (local, HDFS, S3, GCS).  A task writes files under a
name of its own attempt and returns their manifest rows; the manifest is
written as a table by Spark, which commits each task once.  Files of a lost or
repeated attempt are in no manifest and are never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri:
        uri = uri[5:] if uri.startswith("file:") else uri
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def local_form(uri: str) -> str:
    """``file:/x`` (as Hadoop writes it) as ``file:///x``."""
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def new_name(prefix: str, suffix: str) -> str:
    return f"{prefix}-{uuid.uuid4().hex}{suffix}"


def open_out(folder: str, name: str):
    """Output stream of a new file; the folder is made if it is missing."""
    system, path = file_system(local_form(folder))
    system.create_dir(path, recursive=True)
    return system.open_output_stream(f"{path}/{name}", compression=None)


def open_in(folder: str, name: str):
    """Random access to a file; a local one is mapped into memory."""
    system, path = file_system(local_form(folder))
    if isinstance(system, fs.LocalFileSystem):
        import pyarrow as pa
        return pa.memory_map(f"{path}/{name}")
    return system.open_input_file(f"{path}/{name}")
