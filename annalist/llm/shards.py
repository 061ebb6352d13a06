"""Binary shard files in the shared folder, written by tasks and memory-mapped by workers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow.fs as pafs

_LOCAL: dict[str, str] = {}


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri("s3" + uri[3:] if uri.startswith("s3a:") else uri)


def write_arrays(folder: str, name: str, arrays: Sequence[np.ndarray]) -> str:
    """One file with the arrays behind each other. A repeated task writes a file of its own, and only
    the name that the successful attempt gives back is used."""
    target = f"{folder}/{name}-{uuid.uuid4().hex}.bin"
    files, path = _place(target)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    with files.open_output_stream(path) as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a).data if len(a) else b"")
    return target


def map_arrays(uri: str, layout: Sequence[tuple[str, int]]) -> list[np.ndarray]:
    """Arrays of the given types and lengths, mapped. From a store that cannot be mapped, the
    file is first copied to the worker's own folder."""
    files, path = _place(uri)
    if not isinstance(files, pafs.LocalFileSystem):
        if uri not in _LOCAL:
            copy = tempfile.NamedTemporaryFile(delete=False)  # noqa: SIM115
            pafs.copy_files(path, copy.name, source_filesystem=files, destination_filesystem=pafs.LocalFileSystem())
            _LOCAL[uri] = copy.name
        path = _LOCAL[uri]
    out, at = [], 0
    for kind, n in layout:
        out.append(np.memmap(path, kind, "r", at, (n,)) if n else np.empty(0, kind))
        at += n * np.dtype(kind).itemsize
    return out


class Writer:
    """A file that a task writes arrays of 64-bit numbers to, one behind the other. Opened with the first one."""

    def __init__(self, folder: str) -> None:
        self.name = f"{uuid.uuid4().hex}.bin"
        self._target, self._out, self._at = f"{folder}/{self.name}", None, 0

    def add(self, numbers: np.ndarray) -> int:
        """Append; gives the place of the first number."""
        if self._out is None:
            files, path = _place(self._target)
            files.create_dir(path.rpartition("/")[0], recursive=True)
            self._out = files.open_output_stream(path)
        at = self._at
        self._out.write(np.ascontiguousarray(numbers).data)
        self._at += len(numbers)
        return at

    def close(self) -> None:
        if self._out is not None:
            self._out.close()


def read_ranges(folder: str, names: Sequence[str], at: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Arrays that writers have appended; each file is opened once and read in order, only where they lie."""
    out: list[np.ndarray] = [np.empty(0, np.uint64)] * len(names)
    opened, current = None, None
    for i in sorted(range(len(names)), key=lambda i: (names[i], at[i])):
        if names[i] != opened:
            files, path = _place(f"{folder}/{names[i]}")
            if current is not None:
                current.close()
            current, opened = files.open_input_file(path), names[i]
        out[i] = np.frombuffer(current.read_at(8 * int(n[i]), 8 * int(at[i])), np.uint64)
    if current is not None:
        current.close()
    return out
