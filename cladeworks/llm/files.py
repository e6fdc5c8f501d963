"""Binary files in the shared folder, written and read inside tasks.

A task writes to a name of its own attempt and hands back the name in its rows,
so a retried or speculative task never touches another's file; only files named
in the written manifest count.
"""

from __future__ import annotations

import contextlib
import uuid


def _at(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def writing(folder: str, name: str):
    """Yields (uri, stream) of a new file in ``folder``."""
    system, path = _at(folder)
    system.create_dir(path, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(f"{path}/{name}") as out:
        yield f"{folder}/{name}", out


def reading(uri: str):
    """A random-access file; a context manager."""
    system, path = _at(uri)
    return system.open_input_file(path)


def streaming(uri: str):
    """A forward-only stream; a context manager."""
    system, path = _at(uri)
    return system.open_input_stream(path, compression=None)
