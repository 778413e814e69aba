"""Files that tasks write to and read from the shared folder."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs

_END = ".part"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI or an absolute path."""
    return fs.FileSystem.from_uri(uri)


class Output:
    """A file that appears under its name only when it is complete.

    A task that is run again writes its own copy and moves it to the same name, so readers
    never see parts of two attempts.
    """

    def __init__(self, folder: str, name: str) -> None:
        self.fs, root = opened(folder)
        self.fs.create_dir(root, recursive=True)
        self.final = os.path.join(root, name)
        self.draft = os.path.join(root, f".{name}.{uuid.uuid4().hex}{_END}")
        self.stream = self.fs.open_output_stream(self.draft)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def __enter__(self) -> Output:
        return self

    def __exit__(self, kind, error, trace) -> None:  # noqa: ANN001
        self.stream.close()
        if kind is None:
            self.fs.move(self.draft, self.final)
        else:
            self.fs.delete_file(self.draft)


def source(folder: str, name: str):  # noqa: ANN201 - a pyarrow.NativeFile
    """A file of the folder, opened for random access."""
    system, root = opened(folder)
    return system.open_input_file(os.path.join(root, name))
