"""Files in the shared folder that tasks write and read themselves, by URI."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or a plain path."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlparse(uri).path)
    return fs.FileSystem.from_uri(uri)


def attempt_name(stem: str) -> str:
    """A file name of one task attempt; which attempt counts is recorded in its output rows."""
    return f"{stem}-{uuid.uuid4().hex}"


def write(uri: str, *parts: bytes | memoryview | Iterator[bytes]) -> None:
    """Write the parts one after another; an iterator's are made while writing."""
    system, path = resolve(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    with system.open_output_stream(path) as out:
        for p in parts:
            for piece in [p] if isinstance(p, (bytes, memoryview)) else p:
                out.write(piece)


def read(uri: str) -> bytes:
    system, path = resolve(uri)
    with system.open_input_stream(path) as f:
        return f.read()


def mapped(uri: str, count: int) -> np.ndarray:
    """Memory-mapped array of ``count`` unsigned integers, as wide as the file's size tells. A
    file of a remote store is first copied to this machine's scratch space, once for all
    workers."""
    system, path = resolve(uri)
    if not isinstance(system, fs.LocalFileSystem):
        near = os.path.join(tempfile.gettempdir(), hashlib.sha256(uri.encode()).hexdigest())
        if not os.path.exists(near):
            mine = attempt_name(near)
            with system.open_input_stream(path) as f, open(mine, "wb") as out:
                while chunk := f.read(8 << 20):
                    out.write(chunk)
            os.replace(mine, near)
        path = near
    return np.memmap(path, f"<u{os.path.getsize(path) // count}", "r", shape=(count,))
