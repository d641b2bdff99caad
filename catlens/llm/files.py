"""Whole files written atomically from tasks, and range reads, through pyarrow's file systems.

A task may run twice (lost executor, speculation): it writes to a name of its own and renames, so
a reader sees a whole file or none, and equal input gives an equal file.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyarrow import fs as pafs


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def atomic_writer(uri: str) -> Iterator:
    """A binary stream whose content appears under uri when the block ends without an error."""
    system, path = _open(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path}.{uuid.uuid4().hex}.part"
    try:
        with system.open_output_stream(own) as out:
            yield out
        if not isinstance(system, pafs.LocalFileSystem) and system.get_file_info(path).type != pafs.FileType.NotFound:
            system.delete_file(path)
        system.move(own, path)
    except BaseException:
        with contextlib.suppress(OSError):
            system.delete_file(own)
        raise


class RangeReader:
    """Range reads of one file."""

    def __init__(self, uri: str):
        system, path = _open(uri)
        self._file = system.open_input_file(path)
        self.size = self._file.size()

    def read(self, offset: int, length: int) -> bytes:
        data = self._file.read_at(length, offset)
        if len(data) != length:
            raise EOFError(f"{len(data)} of {length} bytes at {offset}")
        return data

    def close(self) -> None:
        self._file.close()

    def __enter__(self) -> RangeReader:
        return self

    def __exit__(self, *_) -> None:
        self.close()
