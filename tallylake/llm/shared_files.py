"""Files of an operator's own format in a folder that driver and executors share."""

from __future__ import annotations

import re

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI, or of a plain path."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", uri))


def create(folder: str, name: str):
    """An output stream for a new file. Every attempt of a task takes a name of its own and reports it with its result."""
    system, path = locate(folder)
    system.create_dir(path, recursive=True)
    return system.open_output_stream(f"{path}/{name}", compression=None)


def open_file(uri: str):
    system, path = locate(uri)
    return system.open_input_file(path)
