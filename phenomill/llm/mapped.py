"""Files of arrays in the shared folder, written whole by tasks and mapped by workers."""

from __future__ import annotations

import os
import uuid

import numpy as np
from pyarrow import fs


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_file(folder: str, name: str, parts: list[np.ndarray]) -> None:
    """A whole file or none: a second attempt of a task writes the same bytes again."""
    system, path = _place(folder)
    system.create_dir(path)
    local = isinstance(system, fs.LocalFileSystem)
    target = f"{path}/{name}"
    at = f"{path}/.{name}-{uuid.uuid4().hex}" if local else target
    with system.open_output_stream(at) as out:
        for part in parts:
            out.write(np.ascontiguousarray(part))
    if local:
        os.replace(at, target)


def map_file(uri: str) -> np.ndarray | None:
    """The bytes of a file, mapped if it lies in a mounted file system; None if there is none."""
    system, path = _place(uri)
    info = system.get_file_info(path)
    if info.type != fs.FileType.File:
        return None
    if not info.size:
        return np.empty(0, dtype=np.uint8)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, dtype=np.uint8, mode="r")
    with system.open_input_file(path) as source:
        return np.frombuffer(source.read(), dtype=np.uint8)
