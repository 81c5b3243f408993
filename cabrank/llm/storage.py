"""Files that tasks write themselves, by the URI of a folder that all executors share.

A file appears under its final name only when it is whole: it is written under a
temporary name that is unique to the attempt and then moved. Attempts of one task
write equal bytes, so whichever moves last changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import BinaryIO

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or an absolute path, and the path in it."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


@contextmanager
def committed(uri: str, name: str) -> Iterator[BinaryIO]:
    """A binary stream that becomes ``uri/name`` when the block ends well, and nothing otherwise."""
    system, folder = open_folder(uri)
    system.create_dir(folder, recursive=True)
    attempt = f"{folder}/.{name}.{uuid.uuid4().hex}"
    try:
        with system.open_output_stream(attempt, compression=None) as stream:
            yield stream
    except BaseException:
        if system.get_file_info(attempt).type == fs.FileType.File:
            system.delete_file(attempt)
        raise
    system.move(attempt, f"{folder}/{name}")
