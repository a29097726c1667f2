"""Small files and plain bytes in any file system that pyarrow reads: local folders, HDFS, S3 and others, by URI or path."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or local path, and the path in it."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri if "://" in uri else fs.LocalFileSystem().normalize_path(uri))


def exists(uri: str) -> bool:
    system, path = place(uri)
    return system.get_file_info(path).type != fs.FileType.NotFound


def read_bytes(uri: str) -> bytes:
    system, path = place(uri)
    with system.open_input_stream(path) as f:
        return f.read()


def write_bytes(uri: str, data: bytes) -> None:
    """Write a file under a name of its own and rename it: a reader sees the old one or the new one, and a task that runs
    again leaves the same file."""
    system, path = place(uri)
    folder = path.rsplit("/", 1)[0]
    system.create_dir(folder, recursive=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(own) as f:
        f.write(data)
    system.move(own, path)


def read_json(uri: str) -> Any:
    return json.loads(read_bytes(uri))


def write_json(uri: str, doc: Any) -> None:
    write_bytes(uri, json.dumps(doc).encode())


def children(uri: str) -> list[str]:
    """Names of what is in a folder."""
    system, path = place(uri)
    return sorted(i.base_name for i in system.get_file_info(fs.FileSelector(path)))


def remove_folder(uri: str) -> None:
    """A folder with what is in it, if it is there."""
    system, path = place(uri)
    if system.get_file_info(path).type == fs.FileType.Directory:
        system.delete_dir(path)
