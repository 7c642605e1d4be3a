"""Single files on any store that pyarrow knows (local, HDFS, S3, ...), opened inside tasks."""

from __future__ import annotations

import os


def _resolve(path: str):
    from pyarrow import fs

    local = path[5:] if path.startswith("file:") else path
    if "://" not in local:
        return fs.LocalFileSystem(), "/" + local.lstrip("/")
    return fs.FileSystem.from_uri(path)


def open_input(path: str):
    """A seekable binary file."""
    store, inner = _resolve(path)
    return store.open_input_file(inner)


def write_bytes(path: str, data: bytes) -> None:
    """Write one file, making its folders if they are missing."""
    store, inner = _resolve(path)
    try:
        out = store.open_output_stream(inner)
    except FileNotFoundError:
        store.create_dir(os.path.dirname(inner), recursive=True)
        out = store.open_output_stream(inner)
    with out:
        out.write(data)


def first_line(path: str, chunk: int = 65536) -> str:
    """The first line of a text file, whatever its length, without the line end.  Files with the
    ending of a compression (``.gz``) are read through it."""
    head = b""
    store, inner = _resolve(path)
    with store.open_input_stream(inner, compression="detect") as f:
        while b"\n" not in head and (more := f.read(chunk)):
            head += more
    return head.split(b"\n", 1)[0].rstrip(b"\r").decode("utf-8-sig")
