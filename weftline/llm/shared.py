"""Files of arrays in the folder that ``spark.checkpoint.dir`` names.

Tasks write a file under a name of their own and then move it into place, so a repeated task leaves the same
file. Workers map files into memory: straight from a mounted folder, or from an unlinked local copy when the
folder is in a store that has no paths. Only pages that are read take memory, and the system can drop them.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections import OrderedDict

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import SparkSession

from weftline.session import scratch_path

_MAPPED: OrderedDict[str, np.ndarray] = OrderedDict()
MAPPED_FILES = 4096


def new_folder(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, label)


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    if local := re.match(r"(?:file:)?/+(.*)", path):
        return pafs.LocalFileSystem(), "/" + local[1]
    return pafs.FileSystem.from_uri(path)


def put(folder: str, name: str, *parts: bytes | np.ndarray) -> int:
    """Write ``parts`` one after another as ``folder/name``; the length in bytes."""
    with writer(folder, name) as out:
        for part in parts:
            out.write(part)
    return out.size


def read(folder: str, name: str) -> bytes:
    fs, root = _place(folder)
    with fs.open_input_stream(f"{root}/{name}") as stream:
        return stream.read()


def mapped(folder: str, name: str) -> np.ndarray:
    """The bytes of a file, mapped into memory once per worker. FileNotFoundError if there is none."""
    key = f"{folder}/{name}"
    if key in _MAPPED:
        _MAPPED.move_to_end(key)
        return _MAPPED[key]
    fs, root = _place(folder)
    about = fs.get_file_info(f"{root}/{name}")
    if about.type == pafs.FileType.NotFound:
        raise FileNotFoundError(key)
    if isinstance(fs, pafs.LocalFileSystem):
        found = np.memmap(f"{root}/{name}", np.uint8, "r") if about.size else np.zeros(0, np.uint8)
    else:
        with tempfile.TemporaryFile() as copy, fs.open_input_stream(f"{root}/{name}") as stream:
            while block := stream.read(1 << 22):
                copy.write(block)
            copy.flush()
            found = np.memmap(copy, np.uint8, "r") if copy.tell() else np.zeros(0, np.uint8)
    _MAPPED[key] = found
    if len(_MAPPED) > MAPPED_FILES:
        _MAPPED.popitem(last=False)
    return found


def columns(raw: np.ndarray, *kinds: str) -> list[np.ndarray]:
    """Equally long arrays that were written one after another, widest first."""
    rows, at, out = raw.size // sum(np.dtype(k).itemsize for k in kinds), 0, []
    for kind in kinds:
        end = at + rows * np.dtype(kind).itemsize
        out.append(raw[at:end].view(kind))
        at = end
    return out


class writer:
    """A file of the folder that appears under its name once it is complete; left by an error, it never does."""

    def __init__(self, folder: str, name: str):
        self.fs, self.root = _place(folder)
        self.name, self.partial, self.size = name, f"{self.root}/.{name}-{uuid.uuid4().hex}", 0

    def __enter__(self) -> writer:
        self.fs.create_dir(self.root, recursive=True)
        self.stream = self.fs.open_output_stream(self.partial)
        return self

    def write(self, part: bytes | np.ndarray) -> None:
        raw = part if isinstance(part, bytes) else memoryview(np.ascontiguousarray(part)).cast("B") if part.size else b""
        self.stream.write(raw)
        self.size += len(raw)

    def __exit__(self, kind, *_) -> None:
        self.stream.close()
        if kind is not None:
            self.fs.delete_file(self.partial)
            return
        try:
            self.fs.move(self.partial, f"{self.root}/{self.name}")
        except OSError:
            # Some stores don't move over a file that is there: another attempt of the task has written it.
            if self.fs.get_file_info(f"{self.root}/{self.name}").type != pafs.FileType.File:
                raise
            self.fs.delete_file(self.partial)
